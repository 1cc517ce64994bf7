"""Cohort reports: mean expression per gene in two arms of a disease, and their ratio.

Every disease is answered from one scan of the measures: the arms are conditional means over
the same groups, so nothing is read twice and no self-join is needed. Grouping is by disease
and gene; partial means are formed before the shuffle, so a gene that holds a large share of
all rows arrives as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oncolake.functions.text import gene_label
from oncolake.plans.cohorts import (
    COHORTS,
    Arm,
    CohortSpec,
    arm_patients,
    arm_rows,
    cohort_members,
    is_changed,
)
from oncolake.plans.joins import attach_reference, fit_broadcast, fits_broadcast, lookup_join

TOP = 10
REFERENCE = ("name", "chromosome", "info")


def cohort_mean(
    expression: DataFrame,
    patients: DataFrame,
    disease: str,
    arm: Arm,
    broadcast: bool | None = None,
) -> DataFrame:
    """(gene_id, avg_expr) over the measures of one arm."""
    cases = arm_patients(patients, disease, arm)
    return (
        lookup_join(expression, cases, ["case_id"], "left_semi", broadcast)
        .groupBy("gene_id")
        .agg(F.avg("gene_expr").alias("avg_expr"))
    )


def stage_means(
    expression: DataFrame,
    patients: DataFrame,
    specs: Sequence[CohortSpec] = COHORTS,
    broadcast: bool | None = None,
) -> DataFrame:
    """(disease_type, gene_id, early_avg_expr, late_avg_expr) of genes seen in both arms."""
    if broadcast is None:
        # Members are at most the patient rows they are folded from.
        broadcast = fits_broadcast(arm_rows(patients, specs))
    members = cohort_members(patients, specs)
    measured = expression.select("case_id", "gene_id", "gene_expr").filter(
        F.col("gene_id").isNotNull()
    )
    joined = lookup_join(measured, members, ["case_id"], broadcast=broadcast)
    return (
        joined.groupBy("disease_type", "gene_id")
        .agg(
            F.avg(F.when(F.col("early"), F.col("gene_expr"))).alias("early_avg_expr"),
            F.avg(F.when(F.col("late"), F.col("gene_expr"))).alias("late_avg_expr"),
            F.bool_or("early").alias("_in_early"),
            F.bool_or("late").alias("_in_late"),
        )
        .filter(F.col("_in_early") & F.col("_in_late"))
        .drop("_in_early", "_in_late")
    )


def _ratio() -> Column:
    return F.col("late_avg_expr") / F.col("early_avg_expr")


def gene_rows(genome: DataFrame) -> DataFrame:
    """What reports show of a gene."""
    return genome.select(
        F.col("id").alias("gene_id"), F.col("name").alias("gene_name"), "chromosome", "info"
    ).filter(F.col("gene_id").isNotNull())


def with_reference(rows: DataFrame, genome: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """Add gene name, chromosome and description; a gene without reference keeps nulls and a
    gene with several reference rows is repeated."""
    return attach_reference(
        rows,
        gene_rows(genome),
        ["gene_id"],
        salt_by=["gene_name", "chromosome", "info"],
        broadcast=broadcast,
    )


def _ranked_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "disease_type", "gene_id", "gene_name", "fold_change", "chromosome", "info"
    )


def _changed_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "disease_type",
        "gene_id",
        "early_avg_expr",
        "late_avg_expr",
        "gene_name",
        "chromosome",
        "info",
    )


def fold_change(means: DataFrame, genome: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """Late over early mean per disease and gene, with the gene's reference. Not sorted."""
    ratios = means.select("disease_type", "gene_id", _ratio().alias("fold_change"))
    return _ranked_columns(with_reference(ratios, genome, broadcast))


def expression_changed(
    means: DataFrame,
    genome: DataFrame,
    specs: Sequence[CohortSpec] = COHORTS,
    broadcast: bool | None = None,
) -> DataFrame:
    """Genes whose ratio lies outside the thresholds of their disease, with both means."""
    changed = means.filter(is_changed(specs, F.col("disease_type"), _ratio()))
    return _changed_columns(with_reference(changed, genome, broadcast))


def _largest_first() -> list[Column]:
    """Largest ratio first, an undefined ratio before all; equal ratios by gene."""
    return [
        F.desc_nulls_first("fold_change"),
        F.asc_nulls_last("gene_id"),
        F.asc_nulls_last("gene_name"),
        F.asc_nulls_last("chromosome"),
        F.asc_nulls_last("info"),
    ]


def _smallest_first() -> list[Column]:
    """The exact reverse of `_largest_first`."""
    return [
        F.asc_nulls_last("fold_change"),
        F.desc_nulls_first("gene_id"),
        F.desc_nulls_first("gene_name"),
        F.desc_nulls_first("chromosome"),
        F.desc_nulls_first("info"),
    ]


def ranked(rows: DataFrame) -> DataFrame:
    """Fold changes from the largest to the smallest."""
    return rows.orderBy(*_largest_first())


def fold_change_ranked(
    expression: DataFrame,
    patients: DataFrame,
    genome: DataFrame,
    spec: CohortSpec,
    broadcast: bool | None = None,
) -> DataFrame:
    """All genes of one disease, ranked by fold change. Both lookups are measured at once."""
    if broadcast is None:
        few, small = fit_broadcast(arm_rows(patients, [spec]), gene_rows(genome))
    else:
        few = small = broadcast
    return ranked(fold_change(stage_means(expression, patients, [spec], few), genome, small))


def top_changed(
    means: DataFrame, genome: DataFrame, n: int = TOP, increased: bool = True
) -> DataFrame:
    """The n most increased (or decreased) genes of every disease, with rank 1..n.

    The order starts with ratio and gene, so the first n rows after the reference join belong
    to the first n genes before it: only those, at most n per disease, meet the reference.
    """
    order = _largest_first() if increased else _smallest_first()
    per_disease = Window.partitionBy("disease_type")
    best = (
        means.select("disease_type", "gene_id", _ratio().alias("fold_change"))
        .withColumn("_place", F.row_number().over(per_disease.orderBy(*order[:2])))
        .filter(F.col("_place") <= n)
        .drop("_place")
    )
    # At most n genes per disease of the spec list, and of each the n reference rows that come
    # first in the same order: both sides of the join below have a fixed size.
    of_gene = Window.partitionBy("id").orderBy(
        *(F.asc_nulls_last(c) if increased else F.desc_nulls_first(c) for c in REFERENCE)
    )
    named = (
        genome.select("id", *REFERENCE)
        .join(
            F.broadcast(best.select(F.col("gene_id").alias("id")).distinct()), "id", "left_semi"
        )
        .withColumn("_place", F.row_number().over(of_gene))
        .filter(F.col("_place") <= n)
    )
    return (
        _ranked_columns(with_reference(best, named, broadcast=True))
        .withColumn("rank", F.row_number().over(per_disease.orderBy(*order)))
        .filter(F.col("rank") <= n)
    )


def by_place(disease: str = "disease_type") -> list[Column]:
    """Columns of the order in which ranked reports are stored."""
    return [F.asc(disease), *_largest_first()]


def place_key() -> Column:
    """One value of a row that ascends where `ranked` goes down, to find the first of many."""
    ratio = F.col("fold_change")
    # An undefined ratio is before all; what is no number counts as larger than any.
    kind = F.when(ratio.isNull(), 0).when(F.isnan(ratio), 1).otherwise(2)
    rest = [F.struct(F.isnull(c), c) for c in ("gene_id", "gene_name", "chromosome", "info")]
    return F.struct(kind, F.when(kind == 2, -ratio), *rest)


def top_of_one(rows: DataFrame, n: int = TOP, increased: bool = True) -> DataFrame:
    """The first n rows of one disease's stored fold changes, from either end."""
    return rows.orderBy(*(_largest_first() if increased else _smallest_first())).limit(n)


def with_label(rows: DataFrame) -> DataFrame:
    """Add the text shown next to a gene."""
    return rows.withColumn("annotation", gene_label(F.col("gene_name"), F.col("info")))


def expression_scatter(changed: DataFrame) -> DataFrame:
    """Both means and the gene name: one point per changed gene."""
    return changed.select("disease_type", "early_avg_expr", "late_avg_expr", "gene_name")
