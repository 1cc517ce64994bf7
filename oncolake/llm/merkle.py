"""Merkle manifest of a table: a tree of digests for each group, and one over the groups.

A tree is cut into aligned subtrees of HEIGHT levels of edges, its blocks. Blocks are built from
the leaves up: the roots of one layer of blocks are the leaves of the next, until a tree is one
block. A block holds at most 2 ** HEIGHT leaves, however large its tree is, and is one row of the
manifest. Inside, its nodes lie in the van Emde Boas order: the upper half of the levels first,
then each subtree below it, all in the same order again, so that a path from a leaf to the block's
root meets few stretches of memory whatever their size is. `layout` is that order's arithmetic, by
which nodes are stored and siblings found.

A node is the SHA-256 of its children's digests as hexadecimal text; a lone last node's parent is
that of the one digest. A tree ends where a single node remains, so a lone leaf is its own root.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncolake.llm.ranks import placed
from oncolake.llm.shared import written

#: Levels of edges in a block: 1,024 leaves, 64 kB of digests.
HEIGHT = 10
SIZE = 32
#: The name of the tree over the groups' roots.
GROUPS = "*"


# -- one block


@lru_cache(maxsize=32)
def layout(levels: int) -> tuple[np.ndarray, ...]:
    """For each depth of a perfect tree, the addresses of its nodes from left to right."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    upper = levels // 2
    lower = levels - upper
    size = (1 << lower) - 1
    rest = []
    for depth, inside in enumerate(layout(lower)):
        place = np.arange(1 << (upper + depth))
        start = (1 << upper) - 1 + (place >> depth) * size
        rest.append(start + inside[place & ((1 << depth) - 1)])
    return (*layout(upper), *rest)


def digest(*children: str) -> str:
    return sha256("".join(children).encode()).hexdigest()


def _fill(store: bytearray, base: int, levels: int, leaves: Sequence[str]) -> str:
    """Stores the tree over `leaves`, the first ones of a perfect tree's, and returns its root."""
    if levels == 1:
        store[base * SIZE : (base + 1) * SIZE] = bytes.fromhex(leaves[0])
        return leaves[0]
    upper = levels // 2
    lower = levels - upper
    width, size, start = 1 << (lower - 1), (1 << lower) - 1, base + (1 << upper) - 1
    roots = [
        _fill(store, start + k // width * size, lower, leaves[k : k + width])
        for k in range(0, len(leaves), width)
    ]
    parents = [digest(*roots[k : k + 2]) for k in range(0, len(roots), 2)]
    return _fill(store, base, upper, parents)


def levels_of(size: int, total: int, height: int) -> int:
    """Levels of a block of `size` leaves: the full height, unless its tree has no other block."""
    return height + 1 if total > 1 << height else (size - 1).bit_length() + 1


def build(leaves: Sequence[str], levels: int) -> tuple[bytes, str]:
    """The nodes in van Emde Boas order, absent ones as zeros, and the root."""
    store = bytearray(((1 << levels) - 1) * SIZE)
    root = _fill(store, 0, levels, leaves)
    return bytes(store), root


def paths(nodes: bytes, size: int) -> Iterator[list[str]]:
    """For each leaf of a block, what stands beside the way to its root, from the leaf up.

    A sibling is "<" or ">", for left or right of the way, and its digest; "" where there is none.
    """
    levels = (len(nodes) // SIZE).bit_length()
    address = layout(levels)
    # Nodes there are at each depth.
    counts = [-(-size // (1 << (levels - 1 - depth))) for depth in range(levels)]
    for leaf in range(size):
        way, place = [], leaf
        for depth in range(levels - 1, 0, -1):
            beside = place ^ 1
            if beside < counts[depth]:
                at = int(address[depth][beside]) * SIZE
                way.append("<>"[beside > place] + nodes[at : at + SIZE].hex())
            else:
                way.append("")
            place >>= 1
        yield way


def fold(leaf: str, way: Sequence[str]) -> str:
    """The root that a leaf and what stands beside its way make."""
    for beside in way:
        if not beside:
            leaf = digest(leaf)
        elif beside[0] == "<":
            leaf = digest(beside[1:], leaf)
        else:
            leaf = digest(leaf, beside[1:])
    return leaf


# -- layers of blocks

_BLOCK = "tree string, block long, total long, size int, nodes binary, root string"
_LEAF_BLOCK = f"{_BLOCK}, id array<string>, claim array<string>"


def _blocks(leaves: DataFrame, height: int, named: bool) -> DataFrame:
    """The blocks over (tree, place, total, digest), with the leaves' `id` and `claim` if named."""

    def make(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        total = int(rows["total"].iloc[0])
        nodes, root = build(rows["digest"].tolist(), levels_of(len(rows), total, height))
        made = {
            "tree": [key[0]],
            "block": [key[1]],
            "total": [total],
            "size": [len(rows)],
            "nodes": [nodes],
            "root": [root],
        }
        if named:
            made |= {c: [rows[c].tolist()] for c in ("id", "claim")}
        return pd.DataFrame(made)

    block = F.shiftright("place", height).alias("block")
    columns = ["tree", block, "place", "total", "digest", *(["id", "claim"] if named else [])]
    schema = _LEAF_BLOCK if named else _BLOCK
    return leaves.select(*columns).groupBy("tree", "block").applyInPandas(make, schema)


def _layers(leaves: DataFrame, most: int, height: int, named: bool, label: str) -> list[DataFrame]:
    """Written layers of blocks, from the leaves up. `most` is the leaves of the largest tree."""
    layers = []
    while True:
        layers.append(written(_blocks(leaves, height, named and not layers), label))
        if most <= 1 << height:
            return layers
        most = (most + (1 << height) - 1) >> height
        leaves = (
            layers[-1]
            .filter(F.col("total") > 1 << height)
            .select(
                "tree",
                F.col("block").alias("place"),
                F.shiftright(F.col("total") + ((1 << height) - 1), height).alias("total"),
                F.col("root").alias("digest"),
            )
        )


def _tops(layers: list[DataFrame], height: int) -> DataFrame:
    """(tree, root): the last block of each tree."""
    done = None
    for layer in layers:
        some = layer.filter(F.col("total") <= 1 << height).select("tree", "root")
        done = some if done is None else done.unionByName(some)
    return done


_WAY = "tree string, block long, subroot string, top string, way array<string>"


def _below(blocks: DataFrame, height: int) -> DataFrame:
    """(tree, block, subroot, top, way) of the blocks whose roots are the leaves of `blocks`."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ways = [way + row["way"] for way in paths(row["nodes"], row["size"])]
                first = row["block"] << height
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * len(ways), pa.string()),
                        pa.array(range(first, first + len(ways)), pa.int64()),
                        pa.array([row["subroot"]] * len(ways), pa.string()),
                        pa.array([row["top"]] * len(ways), pa.string()),
                        pa.array(ways, pa.list_(pa.string())),
                    ],
                    ["tree", "block", "subroot", "top", "way"],
                )

    source = blocks.select("tree", "block", "size", "nodes", "subroot", "top", "way")
    return source.mapInArrow(step, _WAY)


def _with_ways(layers: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """The lowest layer's blocks with `way`, what stands beside the way from the block's root to
    the top, and the roots on it. `tops` has (tree, subroot, top, way) of each tree's root."""
    above = None
    for k, layer in reversed(list(enumerate(layers))):
        last = layer.filter(F.col("total") <= 1 << height).join(tops, "tree")
        if above is not None:
            inner = layer.filter(F.col("total") > 1 << height).join(above, ["tree", "block"])
            last = last.unionByName(inner)
        if k:
            above = _below(written(last, "merkle-ways"), height)
    return last


# -- the table


@dataclass(frozen=True)
class Manifest:
    """Layers of blocks of the groups' trees and of the tree over them, from the leaves up."""

    groups: list[DataFrame]
    top: list[DataFrame]
    height: int

    def subroots(self) -> DataFrame:
        """(tree, root) of each group."""
        return _tops(self.groups, self.height)


def record_digest(*fields: Column) -> Column:
    """SHA-256 of fields: each "-" if null, else its length in UTF-8 bytes, ":" and its text."""
    texts = [f.cast("string") for f in fields]
    parts = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
        for t in texts
    ]
    return F.sha2(F.concat(*parts), 256)


def tree_name(group: Column) -> Column:
    """The name of a group's tree; names are ordered as groups are, a null group first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def manifest(records: DataFrame, order: str, height: int = HEIGHT) -> Manifest:
    """The manifest of `records`: columns `group`, `digest`, `claim` and one to order by.

    `claim` is a digest to be held against the tree later (that of the record as it is met then);
    the column `order` names the records, and may be null or repeated: equal ones are ordered by
    their digests. An empty table has no blocks.
    """
    rows = records.select(
        tree_name(F.col("group")).alias("tree"),
        F.col(order).alias("order"),
        "digest",
        F.coalesce("claim", "digest").alias("claim"),
    )
    leaves = placed(rows, "tree", ["order", "digest"], "place", "total").select(
        "tree", "place", "total", "digest", F.col("order").cast("string").alias("id"), "claim"
    )
    leaves = written(leaves, "merkle-leaves")
    most = leaves.agg(F.max("total")).first()[0] or 0
    groups = _layers(leaves, most, height, True, "merkle-blocks")
    roots = _tops(groups, height).select(
        F.lit(GROUPS).alias("tree"), F.col("tree").alias("order"), F.col("root").alias("digest")
    )
    named = written(placed(roots, "tree", ["order"], "place", "total"), "merkle-roots")
    count = named.agg(F.max("total")).first()[0] or 0
    leaves = named.select(
        "tree", "place", "total", "digest", F.col("order").alias("id"), F.col("digest").alias("claim")
    )
    return Manifest(groups, _layers(leaves, count, height, True, "merkle-top"), height)


_PROOF = (
    "id string, digest string, subroot string, root string, proof array<string>, "
    "folded_root string, verified boolean"
)


def proofs(made: Manifest) -> DataFrame:
    """For each record its digest, roots, what stands beside its way, and the root that its claim
    and these make; `verified` if that is the root."""
    top = _tops(made.top, made.height).select(
        "tree",
        F.lit(None).cast("string").alias("subroot"),
        F.col("root").alias("top"),
        F.array().cast("array<string>").alias("way"),
    )

    def of_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ways = [way + row["way"] for way in paths(row["nodes"], row["size"])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["id"], pa.string()),
                        pa.array([row["top"]] * len(ways), pa.string()),
                        pa.array(ways, pa.list_(pa.string())),
                    ],
                    ["tree", "top", "way"],
                )

    columns = ["size", "nodes", "id", "claim", "top", "way"]
    tops = written(
        _with_ways(made.top, top, made.height)
        .select(columns)
        .mapInArrow(of_groups, "tree string, top string, way array<string>"),
        "merkle-tops",
    )

    def of_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                address = layout((len(row["nodes"]) // SIZE).bit_length())[-1]
                found = []
                for k, way in enumerate(paths(row["nodes"], row["size"])):
                    at = int(address[k]) * SIZE
                    own = row["nodes"][at : at + SIZE].hex()
                    whole = way + row["way"]
                    folded = fold(row["claim"][k], whole)
                    found.append(
                        (
                            row["id"][k],
                            own,
                            row["subroot"],
                            row["top"],
                            [w[1:] for w in whole if w],
                            folded,
                            folded == row["top"],
                        )
                    )
                kinds = [pa.string()] * 4 + [pa.list_(pa.string()), pa.string(), pa.bool_()]
                names = ["id", "digest", "subroot", "root", "proof", "folded_root", "verified"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), kinds, strict=True)], names
                )

    subroots = made.subroots().withColumnRenamed("root", "subroot")
    blocks = _with_ways(made.groups, tops.join(subroots, "tree"), made.height)
    return blocks.select(*columns, "subroot").mapInArrow(of_records, _PROOF)


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.concat_ws("", proof), 256)
