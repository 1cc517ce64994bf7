"""SimHash near-duplicates through an inverted index of the fingerprints' bytes.

Two 64-bit fingerprints that differ in at most four bits share at least four of their eight
bytes, place by place. A list of the index holds the fingerprints with the same bytes at three
places; the list of a single byte would be 1/256 of all fingerprints. Two fingerprints that share
four bytes meet in four of the 56 lists or more. Those that meet are tallied: the places whose
bytes they share are counted, and a pair with the guaranteed four is verified by its bits.

Only distinct fingerprints are indexed. A list's fingerprints give a spanning forest of their
links, not all pairs, so a large group of near copies costs as many links as it has members; the
components are those of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncolake.llm.components import components
from oncolake.llm.shared import PARTS, checkpointed, release_memory, with_total

WORDS = 4
SEED = 42
MAX_BITS = 4
BYTES = 8
#: Bytes that a pair within MAX_BITS shares at least.
SHARED = BYTES - MAX_BITS
#: Bytes that the fingerprints of one list share. A list has 2^-24 of all fingerprints, besides near
#: copies: with more than some 10^9 of them take SHARED bytes, which makes 70 lists.
LISTED = 3

#: Fingerprints under one entry that one task compares; more are dealt out in pairs of blocks.
GROUP = 20_000
#: Hashes of one text that are counted at once.
SLICE = 1 << 16


def fingerprint(text: str | None) -> int:
    """The signed 64-bit fingerprint of a text; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    reach = min(WORDS, len(words)) - 1
    spans = zip(start[: len(words) - reach].tolist(), end[reach:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], ">u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), SLICE):
        part = hashes[k : k + SLICE].view(np.uint8).reshape(-1, BYTES)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and `fp` of every row; a null text counts as empty."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], ["id", "fp"]
            )
        release_memory()

    return source.mapInArrow(hash_, f"id {kind}, fp long")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, fp) for every list that a fingerprint is in."""
    places = list(combinations(range(BYTES), LISTED))
    for batch in batches:
        fp = batch.column(0).to_numpy()
        raw = np.ascontiguousarray(fp).view(np.uint8).reshape(-1, BYTES)
        for k, chosen in enumerate(places):
            value = np.full(len(fp), k, np.int64)
            for place in chosen:
                value = value * 256 + raw[:, place]
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(fp)], ["entry", "fp"])


def _shared_bytes(differing: np.ndarray) -> np.ndarray:
    """How many places' bytes are equal, from the differing bits of fingerprints."""
    for shift in (4, 2, 1):
        differing = differing | (differing >> np.uint64(shift))
    return BYTES - np.bitwise_count(differing & np.uint64(0x0101010101010101))


def linked(fps: np.ndarray, one: int) -> np.ndarray:
    """Which fingerprints are within MAX_BITS of one: those that share enough bytes are verified."""
    differing = (fps ^ one).view(np.uint64)
    near = _shared_bytes(differing) >= SHARED
    near[near] = np.bitwise_count(differing[near]) <= MAX_BITS
    return near


def forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links between distinct fingerprints that connect what links of at most MAX_BITS connect."""
    links: list[tuple[int, int]] = []
    left = np.ascontiguousarray(fps, np.int64)
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = linked(left, at)
            if near.any():
                found = left[near]
                links += [(int(at), int(x)) for x in found]
                queue += list(found)
                left = left[~near]
    return links


_FOUND = "u long, v long, crowded boolean"


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links under each entry, from rows sorted by entry; crowded entries as they are."""

    def batch_of(u: list[int], v: list[int], crowded: bool) -> pa.RecordBatch:
        flags = pa.array([crowded] * len(u), pa.bool_())
        return pa.RecordBatch.from_arrays(
            [pa.array(u, pa.int64()), pa.array(v, pa.int64()), flags], ["u", "v", "crowded"]
        )

    entry, held, size, crowded = None, [], 0, False

    def close() -> list[tuple[int, int]]:
        return forest(np.concatenate(held)) if size > 1 and not crowded else []

    for batch in batches:
        keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cut = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
        # Most entries have one fingerprint: only the first, the last and the others are looped.
        sizes = np.diff(cut)
        sizes[[0, -1]] += len(keys) + 1
        links: list[tuple[int, int]] = []
        for k in np.flatnonzero(sizes > 1).tolist():
            a, b = int(cut[k]), int(cut[k + 1])
            if keys[a] != entry:
                links += close()
                entry, held, size, crowded = keys[a], [], 0, False
            held.append(fps[a:b])
            size += b - a
            if size > GROUP:
                rows = np.concatenate(held).tolist()
                yield batch_of([int(entry)] * len(rows), rows, True)
                held, crowded = [], True
        if links:
            yield batch_of([u for u, _ in links], [v for _, v in links], False)
    if links := close():
        yield batch_of([u for u, _ in links], [v for _, v in links], False)


def _dealt(crowded: DataFrame, group: int) -> DataFrame:
    """Links of entries with more than GROUP fingerprints, compared in pairs of blocks."""
    sized = with_total(crowded, "u", "v", F.count(F.lit(1)), F.sum, "size")
    # Another hash than that of the parts.
    own = F.pmod(F.xxhash64("v", F.lit(1)), F.col("blocks")).cast("int")
    paired = (
        sized.select("u", "v", F.ceil(F.col("size") / (group / 2)).cast("int").alias("blocks"))
        .select("u", "v", own.alias("own"), "blocks")
        .select("u", "v", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to"))
        .select(
            F.col("u").alias("entry"),
            F.least("own", "to").alias("i"),
            F.greatest("own", "to").alias("j"),
            F.col("v").alias("fp"),
        )
    )

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(forest(rows["fp"].to_numpy()), columns=["u", "v"], dtype="int64")

    return paired.groupBy("entry", "i", "j").applyInPandas(compare, "u long, v long")


def links(distinct: DataFrame) -> DataFrame:
    """(u, v): links that connect whatever near fingerprints connect. `distinct` has one column."""
    met = checkpointed(
        distinct.mapInArrow(_entries, "entry long, fp long")
        .repartition("entry")
        .sortWithinPartitions("entry")
        .mapInArrow(_meet, _FOUND)
    )
    plain = met.filter(~F.col("crowded")).select("u", "v")
    return plain.unionByName(_dealt(met.filter("crowded").select("u", "v"), GROUP)).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, `fp` and `component`, the smallest id reachable over links, of every row.

    Texts without words, null ones too, have fingerprint 0 and are linked like any other. Rows
    without an id get a component, but are no component's smallest id unless all its rows are
    such. Other columns are not carried on.
    """
    rows = checkpointed(fingerprints(docs, id_col, text_col))
    groups = checkpointed(rows.groupBy("fp").agg(F.min("id").alias("first")))
    roots = components(links(groups.select("fp")))
    rooted = groups.join(roots, groups.fp == roots.node)
    named = with_total(rooted, "root", "fp", F.min("first"), F.min, "component")
    least = groups.join(named.select("fp", "component"), "fp", "left").select(
        "fp", F.coalesce("component", "first").alias("component")
    )
    # The many rows of one fingerprint are dealt to parts, and its component comes to each.
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(PARTS)))
    parts = dealt.select("fp", "part").distinct().join(least, "fp")
    return dealt.join(parts, ["fp", "part"]).select(F.col("id").alias(id_col), "fp", "component")


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each component: of the smallest id, and of its smallest text hash.

    Rows without an id are not compared and stay. Rows that repeat an id with other texts are
    documents of their own; of those that repeat id and text one stays, chosen by the other columns.
    """
    own, key = "__text", "__key"
    while {own, key} & set(docs.columns):
        own, key = own + "_", key + "_"
    with_id = docs.filter(F.col(id_col).isNotNull()).withColumn(own, F.xxhash64(text_col))
    pair = F.struct(F.col(id_col).alias("id"), F.col(own).alias("hash"))
    found = near_duplicates(with_id.withColumn(key, pair), key, text_col)
    kept = (
        found.filter(F.col(key) == F.col("component"))
        .select(F.col(key)["id"].alias(id_col), F.col(key)["hash"].alias(own))
        .distinct()
    )
    others = F.to_json(F.struct(*(c for c in docs.columns if c != text_col)))
    return (
        with_id.join(kept, [id_col, own], "left_semi")
        .groupBy(id_col, own)
        .agg(F.min_by(F.struct(*docs.columns), others).alias(key))
        .select(f"{key}.*")
        .unionByName(docs.filter(F.col(id_col).isNull()))
    )
