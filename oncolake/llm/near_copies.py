"""Near copies: texts that share 80 % of their five-word shingles, found through SimHash bytes.

The radius of `simhash`, four bits of 64, is too narrow for such texts, which differ in some ten.
Here a text has a longer fingerprint, PLACES bytes over its two-word shingles: two texts of
similarity 0.8 agree in a fourth of the bytes or more, unrelated ones in hardly any. An entry of
the index is MATCHES bytes with their places, so what meets under an entry has the minimum of
matching bytes that a pair is kept for; there are ENTRIES of them. What meets is compared by 64
bits of a sketch of its own, and what is near is verified by its shingles, all of them.

An entry does not give all pairs: each text there is linked with the one in the middle of those it
is near to. A group of copies of one text thus hangs together at that text, and costs as many links
as it has members. Each text's link to the middle of its largest company is verified first. Other
links to a middle are verified only if they would join two groups. At last the texts that are near
any other are joined exactly, again only where that would join two groups: two sets of similarity
0.8 share one of the rarest fifth of each, and have enough behind the first that they share. So
neither a crowd of texts that are near but not similar nor a group of copies is compared in itself.
The groups are the connected components of the links that hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncolake.llm.components import components
from oncolake.llm.shared import checkpointed, release_memory, with_total, written

#: What counts as a near copy.
WORDS = 5
SIMILARITY = 0.8
#: Words of the shingles that the fingerprint is made of: a changed word changes fewer of them.
PRINT_WORDS = 2
#: Bytes of the fingerprint, bytes of an entry, entries of a text. With more than some 10^9 texts,
#: four bytes and four times the entries keep what meets by chance few.
PLACES = 32
MATCHES = 3
ENTRIES = 160
#: Differing bits of the sketch up to which a pair is verified: three standard deviations beyond
#: what similarity 0.8 gives.
NEAR_BITS = 18
#: Texts under one entry that one task compares; more are dealt out in pairs of blocks.
GROUP = 20_000
#: Bits that tell most sets apart that are not similar.
BITS = 1024
#: Links of a task, in the rounds that find groups.
LINKS = 50_000
#: Shingles of one text that are counted at once.
SLICE = 1 << 15

_LANES = PLACES // 8 + 1
_MOST = int(round(SIMILARITY * 1000))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII blanks, A-Z as a-z."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; of all words, if there are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    count = max(1, len(words) - size + 1)
    digest = xxhash.xxh3_64_intdigest
    runs = (digest(b" ".join(words[k : k + size])) for k in range(count))
    return np.unique(np.fromiter(runs, np.uint64, count))


def _mixed(hashes: np.ndarray, lane: int) -> np.ndarray:
    """64 further bits of each hash: the finishing steps of a common generator."""
    z = hashes + np.uint64((lane + 1) * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def fingerprint(words: list[bytes]) -> bytes:
    """PLACES bytes and eight of the sketch; a bit is 1 if more than half of the shingles say so."""
    hashes = shingles(words, PRINT_WORDS)
    ones = np.zeros(64 * _LANES, np.int64)
    for k in range(0, len(hashes), SLICE):
        part = hashes[k : k + SLICE]
        lanes = np.stack([_mixed(part, lane) for lane in range(_LANES)], axis=1)
        bits = np.unpackbits(lanes.view(np.uint8).reshape(len(part), -1), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).tobytes()


def places() -> np.ndarray:
    """The places of each entry: shuffles of all places, cut into entries that share none."""
    rng = np.random.default_rng(11)
    found: list[np.ndarray] = []
    while len(found) < ENTRIES:
        order = rng.permutation(PLACES)
        found += list(order[: PLACES // MATCHES * MATCHES].reshape(-1, MATCHES))
    return np.array(found[:ENTRIES])


# -- the index


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node, print) of (key, text): texts of the same words are one node."""
    for batch in batches:
        nodes, prints = [], []
        for text in batch.column(1):
            words = words_of(text.as_py())
            nodes.append(xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63))
            prints.append(fingerprint(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(nodes, pa.int64()), pa.array(prints, pa.binary())],
            ["key", "node", "print"],
        )
    release_memory()


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, sketch, node) for every entry of each (node, print)."""
    chosen = places()
    for batch in batches:
        for at in range(0, batch.num_rows, 4_096):
            part = batch.slice(at, 4_096)
            node = part.column(0)
            raw = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8)
            raw = raw.reshape(part.num_rows, -1)
            sketch = pa.array(np.ascontiguousarray(raw[:, PLACES:]).view(np.int64).ravel())
            for k, where in enumerate(chosen):
                value = np.full(part.num_rows, k, np.int64)
                for place in where:
                    value = value * 256 + raw[:, place]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value), sketch, node], ["entry", "sketch", "node"]
                )


def _apart(sketches: np.ndarray, one: np.int64) -> np.ndarray:
    return np.bitwise_count((sketches ^ one).view(np.uint64))


def links_of(sketches: np.ndarray, nodes: np.ndarray) -> list[tuple[int, int, int]]:
    """(u, v, company) between near nodes: each to its middle, with the number that has the same
    one, and to its nearest, with 0."""
    if len(nodes) == 2:
        apart = (int(sketches[0]) ^ int(sketches[1])) & (2**64 - 1)
        return [(int(nodes[0]), int(nodes[1]), 1)] if apart.bit_count() <= NEAR_BITS else []
    found = []
    for k in range(len(nodes)):
        apart = _apart(sketches, sketches[k])
        apart[k] = 65
        nearest = int(apart.argmin())
        if apart[nearest] <= NEAR_BITS:
            found.append((int(nodes[k]), int(nodes[nearest]), 0))
    left = np.arange(len(nodes))
    while len(left) > 1:
        raw = np.ascontiguousarray(sketches[left]).view(np.uint8).reshape(len(left), 8)
        common = np.packbits(2 * np.unpackbits(raw, axis=1).sum(axis=0) > len(left))
        middle = left[_apart(sketches[left], common.view(np.int64)[0]).argmin()]
        near = _apart(sketches[left], sketches[middle]) <= NEAR_BITS
        own = int(near.sum()) - 1
        found += [(int(nodes[k]), int(nodes[middle]), own) for k in left[near] if k != middle]
        left = left[~near]
    return found


_FOUND = "u long, v long, company long, sketch long"


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links under each entry, from rows sorted by entry; of a crowded entry its rows, as (entry,
    node) with their sketch."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        names = ["u", "v", "company", "sketch"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    entry, held, size, crowded = None, [], 0, False

    def rows() -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.concatenate([h[k] for h in held]) for k in (0, 1))

    def close() -> list[tuple]:
        return [(*link, None) for link in links_of(*rows())] if size > 1 and not crowded else []

    for batch in batches:
        keys, sketches, nodes = (batch.column(k).to_numpy() for k in range(3))
        cut = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
        # Most entries have one text: only the first, the last and the others are looped.
        sizes = np.diff(cut)
        sizes[[0, -1]] += len(keys) + 1
        out = []
        for k in np.flatnonzero(sizes > 1).tolist():
            a, b = int(cut[k]), int(cut[k + 1])
            if keys[a] != entry:
                out += close()
                entry, held, size, crowded = keys[a], [], 0, False
            held.append((sketches[a:b], nodes[a:b]))
            size += b - a
            if size > GROUP:
                fps, names = rows()
                pairs = zip(fps.tolist(), names.tolist(), strict=True)
                out += [(int(entry), name, 0, fp) for fp, name in pairs]
                held, crowded = [], True
        if out:
            yield batch_of(out)
    if out := close():
        yield batch_of(out)


def _dealt(crowded: DataFrame, group: int) -> DataFrame:
    """Links of entries with more than GROUP texts, compared in pairs of blocks."""
    sized = with_total(crowded, "entry", "node", F.count(F.lit(1)), F.sum, "size")
    blocks = F.ceil(F.col("size") / (group / 2)).cast("int")
    # Another hash than that of the parts.
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")
    paired = (
        sized.withColumn("blocks", blocks)
        .select("entry", "sketch", "node", own.alias("own"), "blocks")
        .withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "entry",
            F.least("own", "to").alias("i"),
            F.greatest("own", "to").alias("j"),
            "sketch",
            "node",
        )
    )

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        found = links_of(rows["sketch"].to_numpy(), rows["node"].to_numpy())
        return pd.DataFrame(found, columns=["u", "v", "company"], dtype="int64")

    schema = "u long, v long, company long"
    return paired.groupBy("entry", "i", "j").applyInPandas(compare, schema)


def met_under_entries(nodes: DataFrame) -> DataFrame:
    """What `_meet` finds of texts (node, print)."""
    return checkpointed(
        nodes.mapInArrow(_entries, "entry long, sketch long, node long")
        .repartition("entry")
        # Ties are broken by the order of rows.
        .sortWithinPartitions("entry", "node")
        .mapInArrow(_meet, _FOUND)
    )


def candidates(met: DataFrame) -> DataFrame:
    """Distinct links (u, v, company) between texts that are worth verifying: from a text to its
    middle, with the largest company it has there, or to its nearest one, with 0."""
    crowded = met.filter(F.col("sketch").isNotNull()).select(
        F.col("u").alias("entry"), F.col("v").alias("node"), "sketch"
    )
    plain = met.filter(F.col("sketch").isNull()).select("u", "v", "company")
    both = plain.unionByName(_dealt(crowded, GROUP))
    return both.groupBy("u", "v").agg(F.max("company").alias("company"))


def near_members(met: DataFrame) -> DataFrame:
    """(node) of the texts that are near another one under an entry, or in a crowded one."""
    plain = met.filter(F.col("sketch").isNull()).select("u", "v")
    crowded = met.filter(F.col("sketch").isNotNull()).select(F.col("v").alias("node"))
    return _ends(plain).unionByName(crowded).distinct()


_BITS = [f"b{k}" for k in range(BITS // 64)]
_SETS = f"node long, held array<long>, size int, more int, bits struct<{', '.join(f'{b}: long' for b in _BITS)}>"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of (node, text), their number, BITS bits of which each shingle sets one, and by how
    many the shingles are more than the bits that are set."""
    for batch in batches:
        held = [shingles(words_of(t.as_py()), WORDS) for t in batch.column(1)]
        marks = np.zeros((len(held), BITS), np.uint8)
        for row, own in zip(marks, held, strict=True):
            row[own % np.uint64(BITS)] = 1
        packed = np.packbits(marks, axis=1).view(np.int64)
        size = np.array([len(own) for own in held], np.int32)
        columns = [
            batch.column(0),
            pa.array([own.view(np.int64) for own in held], pa.list_(pa.int64())),
            pa.array(size),
            pa.array(size - marks.sum(axis=1, dtype=np.int32)),
            pa.StructArray.from_arrays([pa.array(packed[:, k]) for k in range(len(_BITS))], _BITS),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["node", "held", "size", "more", "bits"])
    release_memory()


def _enough(shared: Column, sizes: Column) -> Column:
    """Whether sets of so many shingles in sum, of them so many shared, are similar."""
    # shared / (sizes - shared) >= SIMILARITY, in whole numbers of a thousandth.
    return shared * (1000 + _MOST) >= sizes * _MOST


def _at_most() -> Column:
    """What sets `a` and `b` share at most: a bit that one has alone stands for a shingle of it."""
    both = (F.col(f"a.bits.{b}").bitwiseAND(F.col(f"b.bits.{b}")) for b in _BITS)
    return reduce(Column.__add__, map(F.bit_count, both)) + F.least("a.more", "b.more")


def _similar(links: DataFrame, sets: DataFrame) -> DataFrame:
    """The links (u, v) between similar sets. Most others show in the bits, and only what is left
    meets its sets."""

    def joined(rows: DataFrame, *columns: str) -> DataFrame:
        for end, side in (("u", "a"), ("v", "b")):
            own = sets.select(F.col("node").alias(end), F.struct(*columns).alias(side))
            rows = rows.join(own, end)
        return rows

    sizes = F.col("a.size") + F.col("b.size")
    likely = joined(links, "size", "more", "bits").filter(_enough(_at_most(), sizes)).select("u", "v")
    shared = F.size(F.array_intersect("a.held", "b.held"))
    found = joined(checkpointed(likely), "size", "held").filter(_enough(shared, sizes))
    return found.select("u", "v")


def _ends(links: DataFrame) -> DataFrame:
    sides = [links.select(F.col(end).alias("node")).distinct() for end in "uv"]
    return sides[0].unionByName(sides[1]).distinct()


def _between_groups(links: DataFrame, held: DataFrame) -> DataFrame:
    """The links whose ends the links `held` do not connect. A text has at most a link for each
    entry, so those of one are looked up together."""
    groups = checkpointed(components(held, LINKS))
    of = {end: groups.withColumnsRenamed({"node": end, "root": f"of_{end}"}) for end in "uv"}
    each = (
        links.groupBy("u")
        .agg(F.collect_list("v").alias("ends"))
        .join(of["u"], "u", "left")
        .select("u", F.coalesce("of_u", "u").alias("of_u"), F.explode("ends").alias("v"))
    )
    return (
        each.join(of["v"], "v", "left")
        .filter(F.col("of_u") != F.coalesce("of_v", "v"))
        .select("u", "v")
    )


def _rarest(sets: DataFrame) -> DataFrame:
    """(node, shingle, size, rest) for those of each set's rarest shingles that another set has:
    of `size` shingles `rest` follow in the order by count and shingle.

    Sets of similarity SIMILARITY share so many shingles that one is among those rows of both.
    """
    each = sets.select("node", "size", F.explode("held").alias("shingle"))
    counted = with_total(each, "shingle", "node", F.count(F.lit(1)), F.sum, "sets")
    shared = counted.filter(F.col("sets") > 1)
    ordered = shared.groupBy("node", "size").agg(
        F.array_sort(F.collect_list(F.struct("sets", "shingle"))).alias("shared")
    )
    # The least number that a similar set has of them; shingles of one set alone come first.
    least = F.ceil(F.col("size") * _MOST / 1000).cast("int")
    first = F.size("shared") - least + 1
    return (
        ordered.filter(first > 0)
        .select("node", "size", F.size("shared").alias("n"), first.alias("k"), "shared")
        .select("node", "size", "n", F.posexplode(F.slice("shared", F.lit(1), F.col("k"))))
        .select("node", "col.shingle", "size", (F.col("n") - F.col("pos") - 1).alias("rest"))
    )


def near_between_groups(sets: DataFrame, held: DataFrame) -> DataFrame:
    """Pairs (u, v) of `sets` that the links `held` do not connect, all similar ones among them.

    Of such a pair one text at least is not in the largest group that a shingle has: only those are
    compared with the others, so a large group of copies is not compared in itself.
    """
    groups = checkpointed(components(held, LINKS)).withColumnRenamed("root", "of")
    named = _rarest(sets).join(groups, "node", "left").withColumn("of", F.coalesce("of", "node"))
    named = checkpointed(named.join(sets.select("node", "more", "bits"), "node"))
    sizes = named.groupBy("shingle", "of").agg(F.count(F.lit(1)).alias("members"))
    largest = sizes.groupBy("shingle").agg(
        F.max_by("of", F.struct("members", "of")).alias("largest"),
        F.count(F.lit(1)).alias("groups"),
    )
    largest = checkpointed(largest.filter(F.col("groups") > 1).select("shingle", "largest"))
    mixed = checkpointed(named.join(largest, "shingle"))
    some = mixed.filter(F.col("of") != F.col("largest")).alias("a")
    every = mixed.alias("b")
    # At the first shingle that both have, it and the rest are all that they can share.
    most = F.least("a.rest", "b.rest") + 1
    sizes = F.col("a.size") + F.col("b.size")
    both = some.join(
        every,
        (F.col("a.shingle") == F.col("b.shingle"))
        & (F.col("a.of") != F.col("b.of"))
        # A pair of which neither text is in the largest group comes once.
        & ((F.col("b.of") == F.col("b.largest")) | (F.col("a.node") < F.col("b.node")))
        & _enough(most, sizes)
        & _enough(_at_most(), sizes),
    )
    u, v = F.col("a.node"), F.col("b.node")
    return both.select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v")).distinct()


def verified(links: DataFrame, members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links of similarity SIMILARITY or more that connect whatever pairs of members connect which
    are so similar.

    `texts` has (node, text), `links` is what `candidates` gave, `members` what `near_members` did.
    """
    wanted = texts.join(members, "node", "left_semi")
    sets = written(wanted.mapInArrow(_sets, _SETS), "shingles")
    middles = links.filter(F.col("company") > 0)
    best = middles.groupBy("u").agg(F.max_by("v", F.struct("company", "v")).alias("v"))
    first = checkpointed(_similar(best, sets))
    further = _similar(_between_groups(middles.select("u", "v"), first), sets)
    held = checkpointed(first.unionByName(further))
    return held.unionByName(_similar(near_between_groups(sets, held), sets))


# -- documents


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each group of near copies: of the smallest id, and then of the
    smallest text hash.

    Texts of equal words are copies whatever their length; texts without words, null ones too,
    are copies of each other. Rows without an id are not compared and stay. Rows that repeat an
    id with other texts are documents of their own; of those that repeat id and text one stays,
    chosen by the other columns.
    """
    own, key = "__text", "__key"
    while {own, key} & set(docs.columns):
        own, key = own + "_", key + "_"
    with_id = docs.filter(F.col(id_col).isNotNull()).withColumn(
        own, F.xxhash64(F.coalesce(text_col, F.lit("")))
    )
    pair = F.struct(F.col(id_col).alias("id"), F.col(own).alias("hash"))
    source = with_id.select(pair.alias("key"), F.col(text_col).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    rows = source.mapInArrow(_prints, f"key {kind}, node long, print binary")
    # Texts of equal words have equal prints.
    nodes = checkpointed(rows.groupBy("node", "print").agg(F.min("key").alias("first")))
    met = met_under_entries(nodes.select("node", "print"))
    links = checkpointed(candidates(met))
    members = checkpointed(near_members(met))
    wanted = nodes.join(members, "node").select("node", "first.*")
    texts = (
        with_id.select(F.col(id_col).alias("id"), F.col(own).alias("hash"), F.col(text_col))
        .join(wanted, ["id", "hash"])
        # One of the rows that repeat id and text.
        .groupBy("node")
        .agg(F.first(text_col).alias("text"))
    )
    groups = components(verified(links, members, texts), LINKS)
    named = nodes.join(groups, "node", "left").select("first", "root")
    best = named.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("first").alias("first"))
    kept = (
        best.select("first.*")
        .unionByName(named.filter(F.col("root").isNull()).select("first.*"))
        .withColumnsRenamed({"id": id_col, "hash": own})
    )
    others = F.to_json(F.struct(*(c for c in docs.columns if c != text_col)))
    return (
        with_id.join(kept, [id_col, own], "left_semi")
        .groupBy(id_col, own)
        .agg(F.min_by(F.struct(*docs.columns), others).alias(key))
        .select(f"{key}.*")
        .unionByName(docs.filter(F.col(id_col).isNull()))
    )
