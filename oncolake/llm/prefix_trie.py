"""Trie of conversations by their turns, built from digests of blocks of turns.

Every conversation is cut into blocks of BLOCK turns (the last may be shorter), and a block's name
is the digest of its turns and of the name before it. Conversations are grouped by these names
first: what is equal up to a block's end is one row from then on, however many share it. A block
that no sibling competes with, none that starts at the same name, has no branch inside, so its
turn boundaries follow from it as they are. Only where siblings diverge are the boundaries between
their turns grouped in their turn.

Sums over subtrees double their reach in every round (1, 2, 4, ... turns), so the rounds grow with
the logarithm of the longest shared conversation. Nodes of a single conversation take no part:
they have one leaf and save nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oncolake.llm.shared import checkpointed, written

#: Turns of a block.
BLOCK = 4
#: The name of the root.
ROOT = ""
#: Conversations whose ids are joined to one text, by ranges of ids.
ID_BITS = 12


def turns(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv, place, digest, chars) of every turn, counted from 0 in each conversation.

    Turns are ordered by number, null first; turns of one number by the digest of role and text.
    A null role or text is empty; rows without a conversation are left out. Texts are read once
    and do not move.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in (role_col, text_col))
    size = F.octet_length(role).cast("string")
    content = F.concat(size, F.lit(":"), role, text)
    in_order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "digest")
    return (
        conversations.filter(F.col(conv_col).isNotNull())
        .select(
            F.col(conv_col).cast("long").alias("conv"),
            F.col(turn_col).alias("turn"),
            F.sha2(content, 256).alias("digest"),
            F.length(text).cast("long").alias("chars"),
        )
        .withColumn("place", F.row_number().over(in_order) - 1)
        .select("conv", "place", "digest", "chars")
    )


def conversation_ids(rows: DataFrame) -> DataFrame:
    return rows.select("conv").distinct()


def with_shared_heads(rows: DataFrame, base: Column, head: Column) -> DataFrame:
    """(conv, place, digest, chars) of conversations whose first `head` turns are those of another.

    `base` and `head` are expressions of `conv`: the first `head` turns of conversation `base`
    (all if it has fewer, none if there is none), then the own turns behind the first `head`.
    Rows of conversations without any turn left have a null place.
    """
    plan = conversation_ids(rows).select(
        "conv", base.alias("base"), head.cast("int").alias("head")
    )
    sizes = rows.groupBy(F.col("conv").alias("base")).agg(F.count(F.lit(1)).alias("size"))
    taken = F.least("head", F.coalesce("size", F.lit(0))).cast("int")
    plan = checkpointed(plan.join(sizes, "base", "left").withColumn("taken", taken))
    wanted = plan.filter(F.col("taken") > 0).select(
        F.col("conv").alias("to"),
        F.col("base").alias("conv"),
        F.explode(F.sequence(F.lit(0), F.col("taken") - 1)).alias("place"),
    )
    heads = wanted.join(rows, ["conv", "place"]).select(
        F.col("to").alias("conv"), "place", "digest", "chars"
    )
    own = (
        plan.join(rows, "conv")
        .filter(F.col("place") >= F.col("head"))
        .select("conv", F.col("taken") + F.col("place") - F.col("head"), "digest", "chars")
    )
    return heads.union(own).unionByName(plan.select("conv"), allowMissingColumns=True)


_CHAIN = (
    "conv long, depth long, before string, name string, turns array<string>, chars array<long>, "
    "last boolean"
)


def _hex(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def name_of(before: str, held: list[str]) -> str:
    """The name behind the turns `held`, of which the block's first follows `before`."""
    return _hex(before + _hex("".join(held))) if held else before


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of each conversation, from rows sorted by conversation and place."""
    conv, depth, before, held, sizes = None, 0, ROOT, [], []
    out: list[tuple] = []

    def close(last: bool) -> str:
        name = name_of(before, held)
        out.append((conv, depth, before, name, held, sizes, last))
        return name

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        kinds += [pa.list_(pa.string()), pa.list_(pa.int64()), pa.bool_()]
        names = ["conv", "depth", "before", "name", "turns", "chars", "last"]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names
        )

    for batch in batches:
        for at, place, digest, chars in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at != conv:
                if conv is not None:
                    close(True)
                conv, depth, before, held, sizes = at, 0, ROOT, [], []
            if place is None:
                continue
            if len(held) == BLOCK:
                before = close(False)
                depth, held, sizes = depth + BLOCK, [], []
            held.append(digest)
            sizes.append(chars)
        if out:
            yield batch_of(out)
            out.clear()
    if conv is not None:
        close(True)
        yield batch_of(out)


def _boundaries(blocks: DataFrame) -> DataFrame:
    """(name, parent, depth, chars, conv, n) of every turn of blocks."""

    def name(k: Column) -> Column:
        held = F.sha2(F.array_join(F.slice("turns", 1, k), ""), 256)
        return F.when(k == 0, F.col("before")).otherwise(F.sha2(F.concat("before", held), 256))

    places = F.sequence(F.lit(0), F.size("turns"))
    named = blocks.withColumn("names", F.transform(places, name))
    each = F.explode(F.sequence(F.lit(1), F.size("turns"))).alias("k")
    return named.select("*", each).select(
        F.get("names", F.col("k")).alias("name"),
        F.get("names", F.col("k") - 1).alias("parent"),
        (F.col("depth") + F.col("k")).alias("depth"),
        F.get("chars", F.col("k") - 1).alias("chars"),
        "conv",
        "n",
    )


def _nodes(chain: DataFrame) -> DataFrame:
    """(name, parent, depth, chars, conv, n) of every node below the root: conv is its smallest
    member, n the number of members."""
    # The digests of blocks decide which conversations are equal so far; the other columns follow.
    keys = ["name", "before", "depth", "turns", "chars"]
    blocks = checkpointed(
        chain.filter(F.size("turns") > 0)
        .groupBy(*keys)
        .agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"))
    )
    competing = (
        blocks.groupBy("before")
        .agg(F.count(F.lit(1)).alias("siblings"))
        .filter(F.col("siblings") > 1)
        .select("before", F.lit(True).alias("diverges"))
    )
    marked = checkpointed(blocks.join(competing, "before", "left"))
    alone = _boundaries(marked.filter(F.col("diverges").isNull()))
    refined = (
        _boundaries(marked.filter("diverges"))
        .groupBy("name", "parent", "depth", "chars")
        .agg(F.min("conv").alias("conv"), F.sum("n").alias("n"))
    )
    return alone.unionByName(refined)


def _ends(chain: DataFrame) -> DataFrame:
    """(name, ends): SHA-256 of the ids of the conversations that end at a node, ascending.

    Ids are first joined in ranges of 2 ** ID_BITS ids, so that a node at which very many end is
    a row for each range; one task streams these in order, as the digest demands.
    """
    ranges = (
        chain.filter("last")
        .groupBy("name", F.shiftright("conv", ID_BITS).alias("range"))
        .agg(F.array_join(F.array_sort(F.collect_list("conv")), ",").alias("ids"))
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, digest = None, None
        for batch in batches:
            done = []
            for at, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at == name:
                    digest.update(b"," + ids.encode())
                    continue
                if name is not None:
                    done.append((name, digest.hexdigest()))
                name, digest = at, sha256(ids.encode())
            yield from listed(done)
        if name is not None:
            yield from listed([(name, digest.hexdigest())])

    def listed(done: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
        if done:
            columns = [pa.array(c, pa.string()) for c in zip(*done, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["name", "ends"])

    return (
        ranges.repartition("name")
        .sortWithinPartitions("name", "range")
        .mapInArrow(join, "name string, ends string")
    )


def _subtree_sums(shared: DataFrame, deepest: int) -> DataFrame:
    """(name, leaves, saved) over the subtree of every node with several members.

    `shared` has (name, parent, leaves, saved), a node's own; all its ancestors are in it.
    A round adds to each node what lies one reach below it, and doubles the reach.
    """
    now = shared.withColumnRenamed("parent", "above")
    reach = 1
    while reach <= deepest:
        add = (
            now.filter(F.col("above").isNotNull())
            .groupBy(F.col("above").alias("name"))
            .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        )
        jump = now.select(F.col("name").alias("above"), F.col("above").alias("next"))
        jumped = now.join(jump.filter(F.col("next").isNotNull()), "above", "left")
        now = checkpointed(
            jumped.join(add, "name", "left").select(
                "name",
                F.col("next").alias("above"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            )
        )
        reach *= 2
    return now.select("name", "leaves", "saved")


def trie(rows: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations, given as rows (conv, place, digest, chars).

    A conversation without turns is a row with a null place; others may have such a row too.
    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256 of every node; the root is the empty sequence. Without
    conversations there is no node, not even the root. A conversation's own digests are chained by
    one task, as a stream.
    """
    chain = written(
        rows.repartition("conv")
        .sortWithinPartitions("conv", F.asc_nulls_first("place"))
        .mapInArrow(_chain, _CHAIN),
        "trie-chain",
    )
    root = (
        chain.filter("last")
        .agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 0)
        .select(
            F.lit(ROOT).alias("name"),
            F.lit(None).cast("string").alias("parent"),
            F.lit(0).cast("long").alias("depth"),
            F.lit(0).cast("long").alias("chars"),
            "conv",
            "n",
        )
    )
    nodes = written(_nodes(chain).unionByName(root), "trie-nodes")
    children = (
        nodes.filter(F.col("parent").isNotNull())
        .groupBy(F.col("parent").alias("name"))
        .agg(
            F.count(F.lit(1)).alias("n_children"),
            F.count_if(F.col("n") == 1).alias("single"),
        )
    )
    known = checkpointed(nodes.join(children, "name", "left"))
    shared = known.filter(F.col("n") > 1).select(
        "name",
        "parent",
        F.when(F.col("n_children").isNull(), 1).otherwise(F.col("single")).alias("leaves"),
        ((F.col("n") - 1) * F.col("chars")).alias("saved"),
    )
    deepest = known.filter(F.col("n") > 1).agg(F.max("depth")).first()[0] or 0
    sums = _subtree_sums(shared, deepest)
    parents = nodes.select(
        F.col("name").alias("parent"), F.col("conv").alias("parent_conv_id")
    )
    return (
        known.join(sums, "name", "left")
        .join(_ends(chain), "name", "left")
        .join(parents, "parent", "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            "parent_conv_id",
            F.col("n").alias("n_convs"),
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
            F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
            F.coalesce("ends", F.lit(_hex(""))).alias("ends_sha256"),
        )
    )
