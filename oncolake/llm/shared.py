"""Helpers of the corpus operators: inputs, and written intermediate tables."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it in
    spark.checkpoint.dir, or as it was given to the context."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A path of its own for an intermediate table in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows computed once and kept in the shared folder, which cuts the lineage.

    Meant for narrow tables; Spark removes the files when the result is no longer used.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a compressed table in the shared folder."""
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Parts of a key's rows that `with_total` forms.
PARTS = 256


def with_total(
    rows: DataFrame,
    key: str,
    spread: str,
    partial: Column,
    total: Callable[[Column], Column],
    name: str,
    keep: Column | None = None,
) -> DataFrame:
    """`rows` with the total of their key as the column `name`, though one key may have most rows.

    `partial` is an aggregate of rows, `total` makes one of partial ones. Rows of a key are dealt to
    PARTS parts by a hash of `spread`; a part's partial aggregate meets those of the other parts,
    and comes back to that part alone, so no row meets more than its own part of the key. With
    `keep`, only rows that it holds for are given back, but all are counted. `rows` are computed
    twice, and need to be the same each time.
    """
    part = "__part"
    dealt = rows.withColumn(part, F.pmod(F.xxhash64(spread), F.lit(PARTS)))
    parts = dealt.groupBy(key, part).agg(partial.alias(name))
    totals = parts.withColumn(name, total(F.col(name)).over(Window.partitionBy(key)))
    wanted = dealt if keep is None else dealt.filter(keep)
    return wanted.join(totals, [key, part]).drop(part)


def release_memory() -> None:
    """Gives what a task has freed back to the system. Idle Python workers would keep it, next
    to those of the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else, unlike lower()."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def extended(df: DataFrame, **kinds: str) -> T.StructType:
    """The schema of `df` with further columns."""
    schema = T.StructType(list(df.schema.fields))
    for name, kind in kinds.items():
        schema = schema.add(name, kind)
    return schema
