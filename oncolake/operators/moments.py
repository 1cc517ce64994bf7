"""Summaries of the measures that can be merged: one row for each batch, disease and gene.

A row has the count, the sum and the sum of squared distances from the mean, for both arms. Rows of
several batches merge to those of all measures, so the reports of a growing archive read each
measure once. An arm is a set of patients, which may change: the members that a batch was summed up
with are kept beside its rows, and a batch whose cases have come to other arms is summed up again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oncolake.functions.statistics import welch
from oncolake.plans.cohorts import COHORTS, CohortSpec, arm_rows, cohort_members
from oncolake.plans.joins import fits_broadcast, lookup_join
from oncolake.sources.tables import load_table, path_exists, save_table

ARMS = ("early", "late")
PARTS = ("n", "total", "spread")
#: Kinds of the columns of an arm, by part.
_KINDS = {"n": "bigint", "total": "double", "spread": "double"}
_SUMS = ", ".join(f"{arm}_{part} {_KINDS[part]}" for arm in ARMS for part in PARTS)


def _of_arm(arm: str) -> list[Column]:
    value = F.when(F.col(arm), F.col("gene_expr"))
    n = F.count(value)
    return [
        n.alias(f"{arm}_n"),
        F.sum(value).alias(f"{arm}_total"),
        (F.var_pop(value) * n).alias(f"{arm}_spread"),
    ]


def moments(
    expression: DataFrame,
    members: DataFrame,
    keys: Sequence[str] = (),
    broadcast: bool | None = None,
) -> DataFrame:
    """Summaries by `keys`, disease and gene of measures, over `members` of the arms.

    `members` is what `cohort_members` gives. One scan; partial sums are formed before the
    shuffle. Null measures and genes are left out.
    """
    measured = expression.select(*keys, "case_id", "gene_id", "gene_expr").filter(
        F.col("gene_id").isNotNull() & F.col("gene_expr").isNotNull()
    )
    joined = lookup_join(measured, members, ["case_id"], broadcast=broadcast)
    sums = [c for arm in ARMS for c in _of_arm(arm)]
    return joined.groupBy(*keys, "disease_type", "gene_id").agg(*sums)


def merge(parts: DataFrame) -> DataFrame:
    """One summary for each disease and gene from those of any number of batches.

    The squared distances from the common mean are those from each batch's own, and what its mean
    lies away from the common one, a sum of positive terms that loses nothing.
    """
    alike = Window.partitionBy("disease_type", "gene_id")
    kept = parts
    for arm in ARMS:
        n, total = F.col(f"{arm}_n"), F.col(f"{arm}_total")
        mean = F.try_divide(F.sum(total).over(alike), F.sum(n).over(alike))
        away = F.try_divide(total, n) - mean
        # One batch's mean is the common one, also where it is infinite.
        single = F.count(F.when(n > 0, 1)).over(alike) == 1
        between = F.when(single, F.lit(0.0)).otherwise(n * away * away)
        kept = kept.withColumn(
            f"{arm}_spread", F.when(n > 0, F.col(f"{arm}_spread") + between)
        )
    return kept.groupBy("disease_type", "gene_id").agg(
        *(F.sum(f"{arm}_{part}").alias(f"{arm}_{part}") for arm in ARMS for part in PARTS)
    )


def in_both_arms(merged: DataFrame) -> DataFrame:
    return merged.filter((F.col("early_n") > 0) & (F.col("late_n") > 0))


def means(merged: DataFrame) -> DataFrame:
    """(disease_type, gene_id, early_avg_expr, late_avg_expr), as `stage_means` has them."""
    return in_both_arms(merged).select(
        "disease_type",
        "gene_id",
        *((F.col(f"{a}_total") / F.col(f"{a}_n")).alias(f"{a}_avg_expr") for a in ARMS),
    )


def difference(merged: DataFrame) -> DataFrame:
    """Welch's test of the difference of both means: t (late less early), its degrees of freedom
    and the two-sided p-value. They are null where an arm has one measure, or neither varies."""
    test = welch(
        *(F.col(f"late_{part}") for part in PARTS), *(F.col(f"early_{part}") for part in PARTS)
    )
    rows = in_both_arms(merged)
    averages = ((F.col(f"{a}_total") / F.col(f"{a}_n")).alias(f"{a}_avg_expr") for a in ARMS)
    counts = (f"{a}_n" for a in ARMS)
    return rows.select("disease_type", "gene_id", *counts, *averages, test.alias("_test")).select(
        "disease_type",
        "gene_id",
        *(f"{a}_n" for a in ARMS),
        *(f"{a}_avg_expr" for a in ARMS),
        "_test.t",
        "_test.df",
        "_test.p_value",
    )


# -- stored summaries


def _schema(gene: str) -> str:
    return f"disease_type string, gene_id {gene}, {_SUMS}, batch string"


def load(spark: SparkSession, path: str, gene: str = "string") -> DataFrame:
    """Stored summaries, without the mark of batches that have no member."""
    rows = load_table(spark, path, schema=_schema(gene))
    return rows.filter(F.col("disease_type").isNotNull())


def stale_batches(cases: DataFrame, members: DataFrame, stored: DataFrame | None) -> list[str]:
    """Batches whose cases are in other arms than `stored` says, or whose run it does not know.

    `cases` has (case_id, run, batch), `stored` what `batch_members` gave.
    """
    now = batch_members(cases, members)
    if stored is None:
        changed = now.select("batch")
    else:
        columns = now.columns
        both = now.withColumn("side", F.lit(1)).unionByName(
            stored.select(*columns).withColumn("side", F.lit(-1))
        )
        changed = both.groupBy(*columns).agg(F.sum("side").alias("side")).filter("side <> 0")
    return sorted(r["batch"] for r in changed.select("batch").distinct().collect())


def batch_members(cases: DataFrame, members: DataFrame) -> DataFrame:
    """(case_id, disease_type, early, late, run, batch) of each batch's cases, and a row without a
    case for the run of the batch itself. Members have a row for each case, disease and arm, so a
    hot case is no more than that here."""
    known = cases.join(members, "case_id").select(*members.columns, "run", "batch")
    marks = cases.select("run", "batch").distinct()
    return known.unionByName(marks, allowMissingColumns=True)


def update(
    spark: SparkSession,
    measures: DataFrame,
    cases: DataFrame,
    patients: DataFrame,
    path: str,
    members_path: str,
    specs: Sequence[CohortSpec] = COHORTS,
) -> list[str]:
    """Sums up the batches of `measures` that are new or whose cases changed arms.

    `measures` is partitioned by `batch`; only those batches are read. `cases` has (case_id, run,
    batch), of every batch at least a row without a case; another `run` tells that a batch was
    replaced. Returns the names of the batches summed up.
    """
    case = dict(measures.dtypes)["case_id"]
    members = cohort_members(patients, specs)
    schema = (
        f"case_id {case}, disease_type string, early boolean, late boolean, run string, batch string"
    )
    stored = None
    if path_exists(spark, members_path):
        stored = load_table(spark, members_path, schema=schema)
    stale = stale_batches(cases, members, stored)
    if not stale:
        return stale
    few = fits_broadcast(arm_rows(patients, specs))
    chosen = measures.filter(F.col("batch").isin(stale))
    sums = moments(chosen, members, ["batch"], few)
    # A mark, so that a batch without members has its earlier rows replaced as well.
    marks = spark.createDataFrame([(b,) for b in stale], "batch string")
    rows = sums.unionByName(marks, allowMissingColumns=True)
    dynamic = {"mode": "overwrite", "partition_by": ["batch"], "partitionOverwriteMode": "dynamic"}
    save_table(rows, path, **dynamic)
    own = batch_members(cases.filter(F.col("batch").isin(stale)), members)
    save_table(own, members_path, **dynamic)
    return stale
