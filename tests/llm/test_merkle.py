"""The manifest against a plain tree, and its layout against the definition."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from oncolake.llm import merkle
from oncolake.llm.queries import ORACLES, op12_merkle_manifest

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def hashed(text):
    return sha256(text.encode()).hexdigest()


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([hashed("".join(now[i : i + 2])) for i in range(0, len(now), 2)])
    return levels


def plain_way(levels, place):
    """(siblings with their side, in order) of one leaf."""
    way = []
    for level in levels[:-1]:
        beside = place ^ 1
        way.append((beside < place, level[beside]) if beside < len(level) else None)
        place //= 2
    return way


def plain(rows):
    """The contract, row by row: (doc_id, source, lang, n_chars, text)."""

    def leaf(row):
        return hashed(
            "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)
        )

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = plain_levels([leaf(r) for r in groups[g]])
    top = plain_levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for place, row in enumerate(groups[g]):
            way = plain_way(trees[g], place) + plain_way(top, k)
            met = list(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                met[3] += 1
            now = leaf(met)
            for beside in way:
                if beside is None:
                    now = hashed(now)
                else:
                    now = hashed(beside[1] + now if beside[0] else now + beside[1])
            proof = hashed("".join(b[1] for b in way if b))
            root = top[-1][0]
            out.append((row[0], leaf(row), trees[g][-1][0], root, proof, now, now == root))
    return sorted(out, key=str)


def write(spark, tmp_path, rows):
    schema = "doc_id long, source string, lang string, n_chars long, text string, tree int"
    data = [(*row, 5) for row in rows]
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def result(spark, sf_dir):
    return sorted((tuple(r) for r in op12_merkle_manifest(spark, sf_dir).collect()), key=str)


@pytest.mark.parametrize("levels", range(1, 9))
def test_layout_is_recursive(levels):
    """Every node has an address of its own; an upper half lies before what is below it."""
    places = merkle.layout(levels)
    assert [len(p) for p in places] == [1 << d for d in range(levels)]
    assert sorted(a for p in places for a in p) == list(range((1 << levels) - 1))
    if levels > 1:
        upper = levels // 2
        assert sorted(a for p in places[:upper] for a in p) == list(range((1 << upper) - 1))
        # The subtree under the first node below the upper half is one stretch.
        first = [places[d][: 1 << (d - upper)] for d in range(upper, levels)]
        held = sorted(a for p in first for a in p)
        assert held == list(range(held[0], held[0] + (1 << (levels - upper)) - 1))


def test_known_layout_of_four_levels():
    assert [p.tolist() for p in merkle.layout(4)] == [
        [0],
        [1, 2],
        [3, 6, 9, 12],
        [4, 5, 7, 8, 10, 11, 13, 14],
    ]


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7, 8, 9, 31, 32, 33])
def test_block_equals_plain_tree(size):
    leaves = [hashed(str(k)) for k in range(size)]
    nodes, root = merkle.build(leaves, merkle.levels_of(size, size, 10))
    levels = plain_levels(leaves)
    assert root == levels[-1][0]
    for k, way in enumerate(merkle.paths(nodes, size)):
        assert [w[1:] for w in way] == [b[1] if b else "" for b in plain_way(levels, k)]
        assert merkle.fold(leaves[k], way) == root


@pytest.mark.parametrize("height", [1, 2, 3, 10])
def test_layers_of_blocks(spark, tmp_path, height):
    """Trees of many blocks and layers, and more groups than a block of the top tree holds."""
    rows = [(k, None, f"g{k % 11:02}" if k % 5 else "hot", 1, f"t{k}") for k in range(300)]
    rows += [(None, "s", None, None, None), (7, "s", "", 2, "")]
    docs = spark.createDataFrame(
        rows, "doc_id long, source string, lang string, n_chars long, text string"
    )
    digest = merkle.record_digest(*(F.col(c) for c in docs.columns))
    records = docs.select("doc_id", F.col("lang").alias("group"), digest.alias("digest"))
    made = merkle.manifest(records.withColumn("claim", F.lit(None).cast("string")), "doc_id", height)
    got = {(r.id, r.digest): r for r in merkle.proofs(made).collect()}
    want = plain(rows)
    assert len(got) == len(want)
    for doc_id, leaf, subroot, root, proof, _, _ in want:
        row = got[None if doc_id is None else str(doc_id), leaf]
        assert (row.subroot, row.root, hashed("".join(row.proof))) == (subroot, root, proof)
        assert row.verified


def test_nulls_repeats_and_long_texts(spark, tmp_path):
    rows = [
        (None, None, None, None, None),
        (None, None, None, None, None),
        (1, "", "", 0, ""),
        (1, "", "", 0, ""),
        (1, "a", "en", 3, "ü€"),
        (1, "b", "en", 3, "other"),
        (2, "b", "en", 9223372036854775807, "x" * 1_000_000),
        (-3, "-", "-", -1, "-"),
        *((k, "s", "de", k, "same") for k in range(20)),
        *((5, "s", "fr", 1, "one row") for _ in range(50)),
    ]
    assert result(spark, write(spark, tmp_path, rows)) == plain(rows)


def test_single_row(spark, tmp_path):
    rows = [(10, "s", "en", 4, "text")]
    assert result(spark, write(spark, tmp_path, rows)) == plain(rows)


def test_empty_table(spark, tmp_path):
    found = op12_merkle_manifest(spark, write(spark, tmp_path, []))
    assert found.columns == COLUMNS
    assert found.collect() == []


def test_matches_sql(spark, duck):
    got = op12_merkle_manifest(spark, SF)
    want = duck.execute(ORACLES["op12_merkle_manifest"])
    assert got.columns == [c[0] for c in want.description] == COLUMNS
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert rows == sorted(want.fetchall(), key=str)
    assert {r[-1] for r in rows} == {True, False}
