"""Places of rows in their group's order, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oncolake.llm.shared import extended, written

PART, LOCAL, SPREAD = "__part", "__local", "__spread"


def _number(group: int):
    """Rows of one range, in order: the place of each among those of its group in this range."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.array(batch.column(group).to_pylist(), object)
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(keys)]]))
            local = np.arange(len(keys)) - np.repeat(starts, sizes)
            if keys[0] == last:
                local[: sizes[0]] += seen
            last, seen = keys[-1], int(local[-1]) + 1
            columns = [*batch.columns, pa.array([part] * len(keys), pa.int32()), pa.array(local)]
            names = [*batch.schema.names, PART, LOCAL]
            yield pa.RecordBatch.from_arrays(columns, names)

    return number


def placed(
    rows: DataFrame, group: str, order: Sequence[str], place: str, total: str
) -> DataFrame:
    """`rows` with two more columns: `place`, from 0, by `order`, among the rows of equal `group`,
    and `total`, the number of these rows.

    `group` is a column of strings without nulls. Rows are dealt to ranges of (group, order), so a
    large group lies in many ranges; the sizes of its ranges, a row for each, give the place
    where each of them begins. Rows that are equal in `order` come in any order, and are dealt to
    several ranges too. Meant for narrow rows: they are written twice.
    """
    # Written first: the ranges are sampled from the same rows that are dealt to them later.
    spread = F.xxhash64(F.monotonically_increasing_id())
    held = written(rows.withColumn(SPREAD, spread), "unplaced")
    by = [F.col(group), *(F.col(c) for c in order), F.col(SPREAD)]
    schema = extended(held, **{PART: "integer", LOCAL: "long"})
    numbered = written(
        held.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .mapInArrow(_number(held.columns.index(group)), schema),
        "ranges",
    )
    every = Window.partitionBy(group)
    before = every.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        numbered.groupBy(group, PART)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(
            group,
            PART,
            F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
            F.sum("__rows").over(every).alias(total),
        )
    )
    return numbered.join(sizes, [group, PART]).select(
        *rows.columns, (F.col(LOCAL) + F.col("__before")).alias(place), total
    )
