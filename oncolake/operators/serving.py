"""Patient summaries, lists and menus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Menu entries, and the one disease whose menu lists the third.
CLINICAL = ("Clinical report", "clinical")
EXPRESSION = ("Gene expression analysis", "geneexpr")
VARIANTS = ("SNP analysis", "snp")
VARIANT_DISEASES = ("Breast",)
STAGED = "Stage"


def project_summary(patients: DataFrame) -> DataFrame:
    """Patients per disease and project; unknown diseases form groups of their own."""
    return patients.groupBy("disease_type", "project_id").agg(
        F.count(F.lit(1)).alias("sample_counts")
    )


def select_patients(
    patients: DataFrame, disease: str | None = None, stage: str | None = None
) -> DataFrame:
    """Patients of a disease, of a stage, or of both."""
    if disease is not None:
        patients = patients.filter(F.col("disease_type") == disease)
    if stage is not None:
        patients = patients.filter(F.col("disease_stage") == stage)
    return patients


def as_json(rows: DataFrame) -> DataFrame:
    """One JSON object per row; nulls are written out."""
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("output"))


def stage_counts(patients: DataFrame, disease: str) -> DataFrame:
    return (
        select_patients(patients, disease)
        .groupBy("disease_stage")
        .agg(F.count(F.lit(1)).alias("counts"))
    )


def gender_counts(patients: DataFrame, disease: str) -> DataFrame:
    return (
        select_patients(patients, disease)
        .groupBy("gender")
        .agg(F.count(F.lit(1)).alias("counts"))
    )


def disease_list(summary: DataFrame) -> DataFrame:
    """Known diseases in alphabetical order."""
    return (
        summary.filter(F.col("disease_type").isNotNull())
        .select("disease_type")
        .distinct()
        .orderBy("disease_type")
    )


def disease_menu(summary: DataFrame) -> DataFrame:
    """(label, value) of each disease, after one blank entry."""
    blank = summary.sparkSession.range(1).select(F.lit("").alias("label"))
    diseases = disease_list(summary).select(F.col("disease_type").alias("label"))
    return (
        blank.unionByName(diseases)
        .select("label", F.col("label").alias("value"))
        .orderBy("label")
    )


def stage_eligibility(patients: DataFrame) -> DataFrame:
    """Number of known stages per disease; arms can be compared where there are several.

    One pass over all diseases: distinct stages are reduced before they are shuffled.
    """
    stage = F.col("disease_stage")
    return (
        patients.filter(F.col("disease_type").isNotNull())
        .groupBy("disease_type")
        .agg(F.count_distinct(F.when(stage.rlike(STAGED), stage)).alias("stage_count"))
        .withColumn("eligible", F.col("stage_count") > 1)
    )


def _entry(entry: tuple[str, str]) -> Column:
    return F.struct(F.lit(entry[0]).alias("label"), F.lit(entry[1]).alias("value"))


def analysis_menu(
    patients: DataFrame, variant_diseases: Sequence[str] = VARIANT_DISEASES
) -> DataFrame:
    """(disease_type, analyses): the analyses offered for each disease, in menu order."""
    none = F.array().cast("array<struct<label: string, value: string>>")
    return stage_eligibility(patients).select(
        "disease_type",
        F.concat(
            F.array(_entry(CLINICAL)),
            F.when(F.col("eligible"), F.array(_entry(EXPRESSION))).otherwise(none),
            F.when(
                F.col("disease_type").isin(*variant_diseases), F.array(_entry(VARIANTS))
            ).otherwise(none),
        ).alias("analyses"),
    )
