"""The patient table kept up to date batch by batch.

Three tables hold it, each in the same slices of a hash of the case id:

- the patients that were ever listed, to which a batch adds those that it lists first;
- the clinical records of each batch, which a second run of the batch replaces;
- the patient table itself, which follows from the other two.

A batch names some slices. Only these are read and written anew, whatever the size of the tables,
and since a slice of the patient table follows from what is stored beside it, a run that broke off
is made good by running its batch again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake import schemas
from oncolake.operators.clinical import update_patients
from oncolake.sources.tables import load_table, path_exists, save_table

#: Slices of the patient table; forty million cases in as many are some hundred megabytes each.
#: Fixed for all runs over the same tables.
SLICES = 64
SLICE = "slice"


def slice_of(case_id: Column, slices: int = SLICES) -> Column:
    """The slice of a case; a null id has one, too."""
    return F.pmod(F.xxhash64(case_id.cast("string")), F.lit(slices)).cast("int")


def _sliced(rows: DataFrame, slices: int) -> DataFrame:
    """Rows with their slice, each slice in one task, so that a batch has one file of it."""
    return rows.withColumn(SLICE, slice_of(F.col("case_id"), slices)).repartition(SLICE)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return load_table(spark, path, schema=f"{schema}, {SLICE} int")


def some(rows: DataFrame, named: Iterable[int]) -> DataFrame:
    """The rows of some slices; no file of another is opened."""
    return rows.filter(F.col(SLICE).isin(*named)) if named else rows.limit(0)


def named_slices(rows: DataFrame, slices: int = SLICES) -> list[int]:
    """The slices of the cases in `rows`, at most `slices` numbers."""
    own = rows.select(slice_of(F.col("case_id"), slices).alias(SLICE)).distinct()
    return sorted(r[SLICE] for r in own.collect())


def create(spark: SparkSession, path: str, schema: str) -> None:
    """The table without slices, unless it is there. A file without rows holds its columns."""
    if not path_exists(spark, path):
        save_table(spark.createDataFrame([], schema), path, mode="ignore")


def append_patients(
    patients: DataFrame,
    path: str,
    named: list[int],
    schema: str = schemas.PATIENT_INFO,
    slices: int = SLICES,
) -> None:
    """Adds the patients that are not stored yet; running a batch again adds nothing.

    A patient is a case in a project, and either may be null. `named` are the slices of `patients`,
    whose rows are distinct. A case that comes in a second project is a second row, as within one
    batch, and is found by `repeated_cases`.
    """
    spark = patients.sparkSession
    create(spark, path, schema)
    stored = some(_stored(spark, path, schema), named)
    keys = ("case_id", "project_id")
    known = stored.select(*(F.col(k).alias(f"_{k}") for k in keys))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    unseen = patients.join(known, same, "left_anti")
    save_table(_sliced(unseen, slices), path, mode="append", partition_by=[SLICE])


def save_records(
    records: DataFrame,
    path: str,
    batch: str,
    schema: str = schemas.CLINICAL,
    slices: int = SLICES,
) -> list[int]:
    """Stores a batch of clinical records in place of its earlier run.

    Returns the slices in which a case has a record of the batch now, or had one before.
    """
    spark = records.sparkSession
    own = f"{path}/batch={batch}"
    before = _held_slices(_stored(spark, own, schema)) if path_exists(spark, own) else []
    save_table(_sliced(records, slices), own, mode="overwrite", partition_by=[SLICE])
    return sorted({*before, *_held_slices(_stored(spark, own, schema))})


def _held_slices(rows: DataFrame) -> list[int]:
    return [r[SLICE] for r in rows.select(SLICE).distinct().collect()]


def refresh(
    spark: SparkSession,
    listed: str,
    records: str,
    target: str,
    named: list[int],
    schema: str = schemas.PATIENT_INFO,
    record_schema: str = schemas.CLINICAL,
) -> None:
    """Makes the named slices of the patient table anew.

    They have the listed patients with the latest record of each over all batches. Other slices
    are neither read nor written.
    """
    for path, kinds in ((listed, schema), (records, record_schema), (target, schema)):
        create(spark, path, kinds)
    if named:
        rows = refreshed(spark, listed, records, named, schema, record_schema)
        save_slices(rows.repartition(SLICE), target)


def save_slices(rows: DataFrame, path: str) -> None:
    """Writes rows with their slice in place of what these slices held."""
    dynamic = {"partitionOverwriteMode": "dynamic"}
    save_table(rows, path, mode="overwrite", partition_by=[SLICE], **dynamic)


def slice_counts(patients: DataFrame) -> DataFrame:
    """The summary by disease and project, for each slice."""
    return patients.groupBy("disease_type", "project_id", SLICE).agg(
        F.count(F.lit(1)).alias("sample_counts")
    )


def slice_repeats(patients: DataFrame) -> DataFrame:
    """Cases with several rows; all rows of a case are in one slice."""
    return (
        patients.groupBy("case_id", SLICE)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


def refreshed(
    spark: SparkSession,
    listed: str,
    records: str,
    named: list[int],
    schema: str = schemas.PATIENT_INFO,
    record_schema: str = schemas.CLINICAL,
) -> DataFrame:
    """The named slices of the patient table, from what is stored beside it."""
    rows = some(_stored(spark, listed, schema), named)
    every = load_table(spark, records, schema=f"{record_schema}, batch string, {SLICE} int")
    own = some(every, named).drop("batch", SLICE)
    return update_patients(rows, own)


def summary_of(counts: DataFrame) -> DataFrame:
    """The summary by disease and project, from the counts of all slices."""
    return counts.groupBy("disease_type", "project_id").agg(
        F.sum("sample_counts").alias("sample_counts")
    )
