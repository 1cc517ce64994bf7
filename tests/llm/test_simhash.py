"""Fingerprints and components against brute force."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from oncolake.llm import simhash
from oncolake.llm.components import components
from oncolake.llm.queries import op2_simhash
from oncolake.llm.shared import with_total

SF = "/root/testdata/sf0.01"


def brute_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def brute_components(rows):
    """Smallest id reachable, by comparing all pairs of fingerprints."""
    fps = sorted({fp for _, fp in rows})
    arr = np.array(fps, np.uint64)
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1 :] ^ arr[i]) <= 4):
            parent[find(i)] = find(i + 1 + int(j))
    root = {fp: find(i) for i, fp in enumerate(fps)}
    least = {}
    for id_, fp in rows:
        if id_ is not None:
            least[root[fp]] = min(id_, least.get(root[fp], id_))
    return [least.get(root[fp]) for _, fp in rows]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, component string")


def unsigned(fp):
    return fp % (1 << 64)


TEXTS = [
    None, "", " \t\n", "One", "one", "ONE two", "one two three four", "É é", "é É",
    "a b c d e f g h " * 300, "a b c d e f g h " * 300 + "x", "w " * 5000, "w", "\x1c a b c d",
]


def test_fingerprints(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(0, "again one two", None), (None, "w", "")]
    got = simhash.fingerprints(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    want = {(i, brute_fingerprint(t)) for i, t, _ in rows}
    assert {(r.id, unsigned(r.fp)) for r in got} == want


def test_slices_count_all(monkeypatch):
    monkeypatch.setattr(simhash, "SLICE", 7)
    text = " ".join(map(str, range(100)))
    assert unsigned(simhash.fingerprint(text)) == brute_fingerprint(text)


def near(rng, fp, bits):
    for b in rng.choice(64, bits, replace=False):
        fp ^= 1 << int(b)
    return fp


@pytest.mark.parametrize("group", [simhash.GROUP, 10])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, group):
    """Clusters, chains of links, one dense group, in one task and dealt out in blocks."""
    rng = np.random.default_rng(7)
    fps = set()
    for _ in range(40):
        fp = int(rng.integers(0, 1 << 63))
        fps.add(fp)
        for _ in range(6):
            fp = near(rng, fp, int(rng.integers(1, 7)))
            fps.add(fp)
    dense = int(rng.integers(0, 1 << 63))
    fps |= {near(rng, dense, int(rng.integers(0, 4))) for _ in range(150)} | {0, (1 << 64) - 1}
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in fps]
    monkeypatch.setattr(simhash, "GROUP", group)
    found = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    roots = {r.node: r.root for r in components(found).collect()}
    got = {}
    for fp in signed:
        got.setdefault(roots.get(fp, fp), set()).add(unsigned(fp))
    rows = [(i, fp) for i, fp in enumerate(sorted(fps))]
    want = {}
    for (_, fp), c in zip(rows, brute_components(rows), strict=True):
        want.setdefault(c, set()).add(fp)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert len(want) < len(fps)


def test_tally_of_shared_bytes():
    rng = np.random.default_rng(3)
    one = int(rng.integers(0, 1 << 62))
    others = [near(rng, one, int(b)) for b in rng.integers(0, 12, 400)]
    fps = np.array([f - (1 << 64) if f >> 63 else f for f in [*others, one ^ (1 << 64) - 1]])
    pairs = [((one ^ f) & (1 << 64) - 1).to_bytes(8, "big") for f in fps.tolist()]
    shared = simhash._shared_bytes((fps ^ one).view(np.uint64))
    assert shared.tolist() == [p.count(0) for p in pairs]
    near_ = [p.count(0) >= 4 and sum(b.bit_count() for b in p) <= 4 for p in pairs]
    assert simhash.linked(fps, one).tolist() == near_
    assert {sum(b.bit_count() for b in p) <= 4 for p in pairs} == {True, False}


def test_totals_of_a_hot_key(spark):
    """Most rows have one key, which is dealt to many parts; nulls are a value like others."""
    data = [("hot", i) for i in range(3000)] + [("a", 5), ("a", 3), ("b", None), ("hot", 7)]
    rows = spark.createDataFrame(data, "k string, n long")
    got = with_total(rows, "k", "n", F.min("n"), F.min, "least", keep=~F.col("n").between(8, 2990))
    want = [(k, n, {"hot": 0, "a": 3, "b": None}[k]) for k, n in data if n is None or not 8 <= n <= 2990]
    want = [w for w in want if w[1] is not None]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    counted = with_total(rows, "k", "n", F.count(F.lit(1)), F.sum, "size").groupBy("k", "size").count()
    assert {tuple(r) for r in counted.collect()} == {("hot", 3001, 3001), ("a", 2, 2), ("b", 1, 1)}


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1050)] + [(7, 7), (1000, 7), (None, 3)]
    found = components(spark.createDataFrame(chain + star, "a long, b long")).collect()
    got = {r.node: r.root for r in found}
    assert len(found) == len(got)
    assert got == {**dict.fromkeys(range(100, 161), 100), 7: 7, **dict.fromkeys(range(1000, 1050), 7)}


def test_empty_table(spark):
    empty = docs_of(spark, [])
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.deduplicate(empty).collect() == []


def test_deduplicate(spark):
    rows = [(5, "same words here now", "a"), (3, "same words here now", "b"), (9, "other", "c"),
            (9, "other", "d"), (None, "same words here now", "e"), (None, None, None), (4, None, "f"),
            (2, "", "g")]
    got = simhash.deduplicate(docs_of(spark, rows))
    assert got.columns == ["doc_id", "text", "component"]
    kept = sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect())
    assert kept == [(False, 2), (False, 3), (False, 9), (True, 0), (True, 0)]


def test_deduplicate_ids_with_several_texts(spark):
    copy, lone = "one text that is copied here", "another text that stands alone"
    rows = [(9, lone, "a"), (9, copy, "b"), (3, copy, "c"), (3, copy, "d"), (1, lone + " x", "e"),
            (1, "a third text of the id", "f"), (4, "a third text of the id", "g")]
    want = {(9, lone, "a"), (3, copy, "c"), (1, lone + " x", "e"), (1, "a third text of the id", "f")}
    for order in (rows, rows[::-1]):
        got = simhash.deduplicate(docs_of(spark, order).repartition(3)).collect()
        assert len(got) == len(want) and set(map(tuple, got)) == want


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    got = op2_simhash(spark, SF).toPandas().sort_values("doc_id", ignore_index=True)
    docs = docs.sort_values("doc_id", ignore_index=True)
    fps = [brute_fingerprint(t) for t in docs.text]
    want = pd.DataFrame({"doc_id": docs.doc_id, "fingerprint": [f"{f:016x}" for f in fps]})
    want["component_id"] = brute_components(list(zip(docs.doc_id.tolist(), fps, strict=True)))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
    assert (got.doc_id != got.component_id).sum() > 10
