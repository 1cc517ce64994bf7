"""Stored reports: every table the reports consist of, from one scan of the measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake import schemas
from oncolake.operators.cohort import (
    TOP,
    by_place,
    expression_changed,
    fold_change,
    gene_rows,
    place_key,
    stage_means,
    top_of_one,
)
from oncolake.operators.serving import project_summary
from oncolake.plans.cohorts import COHORTS, CohortSpec
from oncolake.plans.joins import fits_broadcast
from oncolake.sources.files import relative_path
from oncolake.sources.tables import load_table, save_table

#: Rows of one file of a ranked report.
ROWS_PER_FILE = 500_000


def save_reports(
    expression: DataFrame,
    patients: DataFrame,
    genome: DataFrame,
    base: str,
    specs: Sequence[CohortSpec] = COHORTS,
    fmt: str = "parquet",
) -> None:
    """Write summary, fold changes and changed genes below `base`, partitioned by disease.

    The means are written first and read back: both reports then start from a table of one
    row per disease and gene, and a lost executor costs no second scan of the measures.
    Readers of one disease read its partition only; a placeholder disease has none.
    """
    spark = expression.sparkSession
    save_table(project_summary(patients), f"{base}/project_summary", fmt, "overwrite")
    save_table(stage_means(expression, patients, specs), f"{base}/stage_means", fmt, "overwrite")
    means = load_table(spark, f"{base}/stage_means", fmt)
    save_reports_of_means(means, genome, base, fits_broadcast(gene_rows(genome)), specs, fmt)


def save_reports_of_means(
    means: DataFrame,
    genome: DataFrame,
    base: str,
    small: bool,
    specs: Sequence[CohortSpec] = COHORTS,
    fmt: str = "parquet",
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Fold changes and changed genes from stored means; `small` tells that the gene reference can
    be copied. Fold changes are stored in order (`save_ranked`)."""
    by_disease = {"fmt": fmt, "mode": "overwrite", "partition_by": ["disease_type"]}
    save_ranked(fold_change(means, genome, small), base, fmt, rows_per_file)
    save_table(
        expression_changed(means, genome, specs, small), f"{base}/expression_changed", **by_disease
    )


def save_ranked(
    rows: DataFrame, base: str, fmt: str = "parquet", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Write `fold_change_ranked` below `base` in order, and `fold_change_files`: which file of a
    disease has which rows.

    A file holds a stretch of one disease's ranking, from the largest fold change down, and no
    more than `rows_per_file` rows. Stretches are ranges of (disease, ranking), so a disease with
    most of the rows has many files and is no single task.
    """
    spark, table = rows.sparkSession, f"{base}/fold_change_ranked"
    placed = rows.repartitionByRange(*by_place()).sortWithinPartitions(*by_place())
    save_table(
        placed, table, fmt, "overwrite", ["disease_type"], maxRecordsPerFile=str(rows_per_file)
    )
    stored = load_table(spark, table, fmt, rows.schema)
    of_file = stored.select(
        "disease_type", relative_path(spark, table).alias("file"), place_key().alias("place")
    )
    found = of_file.groupBy("disease_type", "file").agg(
        F.count(F.lit(1)).alias("rows"), F.min("place").alias("place")
    )
    save_table(found, f"{base}/fold_change_files", fmt, "overwrite")


def stored_top(
    spark: SparkSession,
    base: str,
    disease: str,
    n: int = TOP,
    increased: bool = True,
    fmt: str = "parquet",
) -> DataFrame:
    """The first or last n rows of a disease's stored ranking, from as few of its files as hold
    them: one, unless the file at that end has fewer than n rows."""
    table = f"{base}/fold_change_ranked"
    held = load_table(spark, f"{base}/fold_change_files", fmt)
    of_disease = held.filter(F.col("disease_type") == disease)
    end = F.asc("place") if increased else F.desc("place")
    # No file is empty, so n of them have n rows.
    wanted, rows = [], 0
    for file in of_disease.orderBy(end).select("file", "rows").limit(n).collect():
        wanted.append(f"{table}/{file['file']}")
        rows += file["rows"]
        if rows >= n:
            break
    empty = spark.createDataFrame([], schemas.FOLD_CHANGE_RANKED)
    if not wanted:
        return empty
    # The folder's name is the disease, whatever type it looks like.
    found = spark.read.format(fmt).load(wanted).withColumn("disease_type", F.lit(disease))
    return top_of_one(found.select(empty.columns), n, increased)
