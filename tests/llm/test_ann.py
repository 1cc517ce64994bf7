"""Neighbours found against brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from oncolake.llm import ann
from oncolake.llm.queries import op1_nearest

KIND = "vec_id long, embedding array<float>, query_id string"


def usable(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, queries, k):
    """id -> [(score, id)] by all pairs, as the docstring of `nearest` has it."""
    best = {}
    for id_, v in rows:
        if id_ is not None and usable(v):
            v = tuple(np.array(v, np.float32).astype(float))
            best[id_] = min(v, best.get(id_, v))
    out = {}
    for id_ in queries:
        if id_ in best:
            q = np.array(best[id_])
            scores = [
                (-(np.array(v) * q).sum(), i)
                for i, v in best.items()
                if i != id_ and len(v) == len(q)
            ]
            out[id_] = [(-s, i) for s, i in sorted(scores)[:k]]
    return out


def by_query(found):
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.score, r.vec_id))
    return out


def recall(got, want):
    hits = [len({i for _, i in got.get(q, [])} & {i for _, i in w}) / len(w) for q, w in want.items()]
    return float(np.mean(hits))


def run(spark, rows, k=20, every=20, **options):
    docs = spark.createDataFrame([(i, v, "x") for i, v in rows], KIND)
    queries = docs.filter(docs.vec_id % every == 0)
    found = ann.nearest(docs, queries, k, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return by_query(found.collect())


def test_small_shards_are_exact(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 8)).astype(np.float32)
    rows = [(int(i), base[i].tolist()) for i in range(300)]
    rows += [(1000 + i, base[5].tolist()) for i in range(60)]  # ties, more than k
    rows += [(2000 + i, (base[7] * (i + 1)).tolist()) for i in range(5)]  # of other lengths
    got = run(spark, rows, every=5, shard_rows=100, query_rows=30)
    want = brute(rows, [i for i, _ in rows if i % 5 == 0], 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        np.testing.assert_allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=1e-12)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [1.0, nan]),
            (80, [inf, 1.0]), (100, [None, 1.0]), (120, []), (None, [1.0, 1.0]), (3, [2.0, 1.0]),
            (3, [-5.0, 1.0]), (140, [1.0, 2.0, 3.0]), (160, [1.0]), (7, [1e38, 1e38]),
            (8, [1e-38, -1e-38]), (9, [-1.0, 0.5])]
    got = run(spark, rows, k=3)
    want = {q: w for q, w in brute(rows, range(0, 200, 20), 3).items() if w}
    assert {q: [i for _, i in g] for q, g in got.items()} == {
        q: [i for _, i in w] for q, w in want.items()
    }


def test_empty_table(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, [1.0])]) == {}


def test_graph_reaches_every_node():
    rng = np.random.default_rng(4)
    tight = rng.normal(size=(1, 16)) + 1e-3 * rng.normal(size=(700, 16))
    far = rng.normal(size=(700, 16)) * 10
    index = ann.build(np.arange(1400), np.concatenate([tight, far]))
    assert len(index) == 1400
    for _, band in index.groupby("band"):
        edges = dict(zip(band.node, band.edges, strict=True))
        seen, front = {0}, [0]
        while front:
            front = [j for i in front for j in edges[i] if j not in seen and not seen.add(j)]
        assert seen == set(edges) == set(range(len(band)))
    assert max(map(len, index.edges)) <= ann.MOST_EDGES + 8


def clustered(rng):
    centres = rng.normal(size=(40, 64))
    return centres[rng.integers(0, 40, 4000)] + 0.05 * rng.normal(size=(4000, 64))


def one_long(rng):
    vectors = rng.normal(size=(4000, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[17] *= 1e4
    return vectors


SHAPES = {
    "clusters": clustered,
    "gaussian": lambda rng: rng.normal(size=(4000, 64)),
    "many dimensions": lambda rng: rng.normal(size=(2000, 256)),
    "lengths": lambda rng: rng.normal(size=(4000, 64)) * np.exp(rng.normal(size=(4000, 1))),
    "one long": one_long,
    "tiny clusters": lambda rng: 1 + 1e-6 * rng.normal(size=(3000, 16)),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_recall_in_one_shard(shape):
    """Whatever the vectors are: 200 queries against all products of a shard."""
    vectors = SHAPES[shape](np.random.default_rng(11))
    queries = np.arange(0, len(vectors), len(vectors) // 200)[:200]
    nodes = ann.build(np.arange(len(vectors)), vectors)
    asked = pd.DataFrame({"id": queries, "vector": list(vectors[queries])})
    found = ann._search_block(nodes, asked, 20, ann.SEARCH_BEAM)
    got = found.groupby("query_id").vec_id.agg(set)
    share = []
    for q in queries:
        products = vectors @ vectors[q]
        products[q] = -np.inf
        share.append(len(set(np.argsort(-products)[:20].tolist()) & got[q]) / 20)
    assert np.mean(share) >= 0.95
    assert min(share) >= 0.7


def test_bands_of_lengths():
    logs = np.array([0.0, -0.4, 3.0, -1.0, 2.5, -30.0, 3.0])
    assert ann._bands(logs).tolist() == [1, 1, 0, 1, 0, 2, 0]
    units, logs = ann._lengths(np.array([[3e200, 4e200], [3e-300, 4e-300], [0.0, -2.0]]))
    np.testing.assert_allclose(units, [[0.6, 0.8], [0.6, 0.8], [0, -1]])
    np.testing.assert_allclose(np.exp2(logs[2]), 2)
    level = ann._level(units, logs)
    np.testing.assert_allclose((level * level).sum(axis=1), 1)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_whole_table(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got = by_query(op1_nearest(spark, path).collect())
    want = brute(rows, [i for i, _ in rows if i % 20 == 0], 20)
    assert got.keys() == want.keys()
    assert recall(got, want) >= 0.95


def test_recall_over_shards(spark):
    path = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{path}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    queries = table.filter("vec_id % 20 = 0")
    got = by_query(ann.nearest(table, queries, shard_rows=700, query_rows=40).collect())
    assert recall(got, brute(rows, [i for i, _ in rows if i % 20 == 0], 20)) >= 0.95
