"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Groups of equal texts are the items. Each goes to the shard where the dot product of its vector
with the shard's residual capacity is highest; large items go first. Only a group that is larger
than a shard is dealt out in parts.

Items beyond a share of a shard are few, since their sum is bounded by the total; they are placed
first, on the driver. The others are packed in cells: every cell gets its items by a hash and
packs them alone, against its share of what the items before left. Cells end up balanced, and so
is their sum, as long as no item is large against a cell's share of a shard. So there are levels
with more and more cells, each for the items that are small against its cells, and each level's
rest is handed on to the next.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oncolake.llm.shared import checkpointed

SHARDS = 40
#: Bytes that a row takes besides its text.
ROW_BYTES = 16
#: Items beyond this share of a cell's part of a shard, in any dimension, are placed before those
#: cells are packed.
LARGE = 1 / 16
#: Cells of a level, for each cell of the level before. The driver places at most
#: shards * GROWTH / LARGE items in each dimension, and a cell has as many at most, on average,
#: but for the last level.
GROWTH = 16
#: Parts that a group larger than a shard is dealt to, for each shard that it would fill.
PARTS = 4
#: Items of a cell, about.
CELL_ITEMS = 50_000
#: Dimensions and their weight in the dot product: the law is balance in bytes.
WEIGHTS = {"bytes": 64.0, "tokens": 1.0, "rows": 1.0}
_KEY = ["hash", "crc", "part"]


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, size, crc32 and token estimate (runs of non-space) of every row, and the key of
    its text: two hashes and the length, which stand for the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("crc"),
        F.regexp_count(text, F.lit(r"\S+")).cast("long").alias("tokens"),
        F.xxhash64(text).alias("hash"),
    )


def _sums() -> list[Column]:
    return [
        F.sum("size").alias("bytes"),
        F.sum("tokens").alias("tokens"),
        F.count("*").alias("rows"),
    ]


def pack(items: np.ndarray, residual: np.ndarray, first: int = 0) -> np.ndarray:
    """The shard of each item, in decreasing order of weight; `residual` is what is left then.

    Items and residuals are shares of an even shard. Of shards with equal products the next one
    from `first` on is taken, so that the rounding of many cells does not meet in one shard.
    """
    weights = np.array(list(WEIGHTS.values()))
    weighted = items * weights
    out = np.empty(len(items), np.int64)
    for k in np.lexsort((np.arange(len(items)), -weighted.sum(axis=1))).tolist():
        product = residual @ weighted[k]
        at = (int(np.argmax(np.roll(product, -first))) + first) % len(residual)
        out[k] = at
        residual[at] -= items[k]
    return out


def _shares(rows: pd.DataFrame, even: dict[str, float]) -> np.ndarray:
    return np.column_stack([rows[d].to_numpy(float) / even[d] for d in WEIGHTS])


def _levels(cells: int) -> list[int]:
    """Numbers of cells, from few that take larger items to `cells`."""
    out = [min(GROWTH, cells)]
    while out[-1] < cells:
        out.append(min(out[-1] * GROWTH, cells))
    return out


def _packer(even: dict[str, float], residual: np.ndarray):
    """Packs one cell against its share of `residual`."""
    rest = np.maximum(residual.sum(axis=0), 1e-9)
    left = residual.copy()

    def pack_cell(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(_KEY, ignore_index=True)
        shares = _shares(cell, even)
        start = left * (shares.sum(axis=0) / rest)
        cell["shard"] = pack(shares, start, int(cell["cell"].iloc[0]) % len(left))
        return cell[[*_KEY, "shard", *WEIGHTS]]

    return pack_cell


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The id, size, text_crc32, tokens, shard and slot (gapless from 0 in each shard) of a row.

    The law is balance in bytes; tokens and rows follow as far as they can. Equal texts are in
    one shard unless they fill more than that. A null text counts as empty. Rows repeated under
    one id are rows like others. Other columns are not carried on.
    """
    rows = checkpointed(measured(docs, id_col, text_col).withColumn("pid", F.spark_partition_id()))
    totals = rows.agg(*_sums()).first()
    # Shares are of 1 at least: a total may be 0.
    even = {d: max(1.0, (totals[d] or 0) / shards) for d in WEIGHTS}
    filled = F.greatest(*(F.col(d) / even[d] for d in WEIGHTS))
    # At most `shards` groups in each dimension are larger than a shard.
    hot = (
        rows.groupBy("hash", "crc")
        .agg(*_sums())
        .filter(filled > 1)
        .select("hash", "crc", F.ceil(filled * PARTS).cast("int").alias("parts"))
    )
    dealt = F.pmod(F.xxhash64("id", "pid"), F.col("parts"))
    parted = (
        rows.join(F.broadcast(hot), ["hash", "crc"], "left")
        .withColumn("part", F.when(F.col("parts").isNull(), 0).otherwise(dealt).cast("int"))
        .drop("parts")
    )
    items = checkpointed(parted.groupBy(*_KEY).agg(*_sums()).withColumn("filled", filled))
    levels = _levels(-(-(totals["rows"] or 1) // CELL_ITEMS))
    large = items.filter(F.col("filled") > LARGE / levels[0]).orderBy(*_KEY).toPandas()
    residual = np.ones((shards, len(WEIGHTS)))
    large["shard"] = pack(_shares(large, even), residual).astype(np.int32)
    kinds = "hash long, crc long, part int, shard int"
    done = docs.sparkSession.createDataFrame(large[[*_KEY, "shard"]], kinds)
    sums = ", ".join(f"{d} long" for d in WEIGHTS)
    for cells, following in zip(levels, [*levels[1:], None], strict=True):
        fits = F.col("filled") <= LARGE / cells
        if following:
            fits &= F.col("filled") > LARGE / following
        cell = F.pmod(F.xxhash64(*_KEY, F.lit("cell")), F.lit(cells)).cast("int")
        placed = (
            items.filter(fits)
            .withColumn("cell", cell)
            .groupBy("cell")
            .applyInPandas(_packer(even, residual), f"{kinds}, {sums}")
        )
        if following:
            placed = checkpointed(placed)
            for row in placed.groupBy("shard").agg(*(F.sum(d).alias(d) for d in WEIGHTS)).collect():
                residual[row["shard"]] -= [row[d] / even[d] for d in WEIGHTS]
        done = done.unionByName(placed.select(*_KEY, "shard"))
    return _with_slots(checkpointed(parted.join(done, _KEY)), id_col)


def _with_slots(placed: DataFrame, id_col: str) -> DataFrame:
    """Slots from counts of two levels: the input partitions in a shard, and the rows in each."""
    before = Window.partitionBy("shard").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    count = placed.groupBy("shard", "pid").agg(F.count("*").alias("n"))
    starts = count.select(
        "shard", "pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("shard", "pid").orderBy("id", "hash")
    return (
        placed.withColumn("n", F.row_number().over(within) - 1)
        .join(starts, ["shard", "pid"])
        .select(
            F.col("id").alias(id_col),
            "size",
            F.col("crc").alias("text_crc32"),
            "tokens",
            "shard",
            (F.col("start") + F.col("n")).cast("long").alias("slot"),
        )
    )
