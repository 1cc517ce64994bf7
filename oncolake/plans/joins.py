"""Joining a large table with a lookup whose size is measured, not assumed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup is copied to every executor only while its measured content stays below this. The
# session setting named below may lower or raise it, but not beyond the last figure: a broadcast
# is gathered on the driver first, whose result size has a bound of its own.
BROADCAST_BYTES = 128 * 1024 * 1024
BROADCAST_SETTING = "spark.oncolake.broadcastBytes"
MOST_BROADCAST_BYTES = 512 * 1024 * 1024
# Number of tasks that the rows of one key of a repeated reference are dealt to.
SPLITS = 64

HOW = ("inner", "left", "left_semi", "left_anti")


def _content_bytes(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        size = F.octet_length(F.col(f"`{field.name}`"))
    elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`"))))
    else:
        return F.lit(8)
    return F.coalesce(size, F.lit(0)) + F.lit(16)


def measured_sizes(*frames: DataFrame) -> list[int]:
    """Size of the rows of each frame, by one distributed aggregate over all of them."""
    sizes = None
    for i, df in enumerate(frames):
        row = sum((_content_bytes(f) for f in df.schema.fields), F.lit(16).cast("bigint"))
        one = df.select(F.lit(i).alias("frame"), row.alias("bytes"))
        sizes = one if sizes is None else sizes.unionAll(one)
    found = {} if sizes is None else dict(sizes.groupBy("frame").sum("bytes").collect())
    return [found.get(i, 0) for i in range(len(frames))]


def measured_bytes(df: DataFrame) -> int:
    return measured_sizes(df)[0]


def fit_broadcast(*frames: DataFrame) -> list[bool]:
    """Whether each of these lookups is small enough to be copied to every executor.

    Measure stored tables once, and hand the answers to the operators that join them.
    """
    if not frames:
        return []
    setting = frames[0].sparkSession.conf.get(BROADCAST_SETTING, str(BROADCAST_BYTES))
    limit = min(int(setting), MOST_BROADCAST_BYTES)
    return [size <= limit for size in measured_sizes(*frames)]


def fits_broadcast(df: DataFrame) -> bool:
    return fit_broadcast(df)[0]


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    broadcast: bool | None = None,
) -> DataFrame:
    """Join large `rows` with a smaller `lookup` on equally named columns.

    A lookup that measures small enough is broadcast, and `rows` do not move. With a larger one
    both sides are joined without a hint: rows that are stored bucketed by the key stay where
    they are, and otherwise adaptive execution cuts the partition of a key with many rows.
    `how` is inner, left, left_semi or left_anti, where it can cut the rows' side. Give
    broadcast=False for a side that is no lookup.
    """
    if how not in HOW:
        raise ValueError(f"unsupported join type: {how}")
    if broadcast is None:
        broadcast = fits_broadcast(lookup)
    return rows.join(F.broadcast(lookup) if broadcast else lookup, list(on), how)


def attach_reference(
    rows: DataFrame,
    reference: DataFrame,
    on: Sequence[str],
    salt_by: Sequence[str],
    broadcast: bool | None = None,
    splits: int = SPLITS,
) -> DataFrame:
    """Left join that keeps every row and fans out over repeated reference keys.

    Beyond the broadcast size it is the reference that may repeat one key very often, on the
    side that a left join does not let adaptive execution cut. So the reference is dealt out, by
    a hash of its `salt_by` columns and of the input partition. A row with a known key then
    meets every part, and finds nothing in some: those finds are dropped, as the key is known to
    be matched elsewhere. `rows` may be the result of a long computation; it is used once.
    """
    if broadcast is None:
        broadcast = fits_broadcast(reference)
    columns = [*rows.columns, *(c for c in reference.columns if c not in on)]
    if broadcast:
        return rows.join(F.broadcast(reference), list(on), "left").select(*columns)
    known = reference.select(*on).distinct().withColumn("_known", F.lit(True))
    marked = lookup_join(rows, known, on, "left", broadcast=False)
    parts = F.when(F.col("_known"), F.sequence(F.lit(0), F.lit(splits - 1)))
    spread = marked.withColumn("_salt", F.explode(F.coalesce(parts, F.array(F.lit(0)))))
    salt = F.pmod(F.xxhash64(*salt_by, F.spark_partition_id()), F.lit(splits)).cast("int")
    dealt = reference.withColumn("_salt", salt).withColumn("_found", F.lit(True))
    return (
        spread.join(dealt, [*on, "_salt"], "left")
        .filter(F.col("_known").isNull() | F.col("_found"))
        .select(*columns)
    )
