"""Features against plain sets, the fit against its optimum, and held-out accuracy."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from oncolake.llm import quality
from oncolake.llm.queries import op11_quality

SF = "/root/testdata/sf0.1"


def plain_features(text):
    raw, words = (text or "").encode(), (text or "").split()
    found = set()
    for n in range(1, 5):
        for k in range(len(raw) - n + 1):
            value = 0
            for byte in raw[k : k + n]:
                value = (value * 257 + byte + 1) % 2**64
            found.add((value * 0x9E3779B97F4A7C15 % 2**64) >> (64 - quality.PLACE_BITS))
        same = ["1" if a == b else "0" for a, b in zip(words, words[1:])]
        for k in range(len(same) - n + 1):
            found.add(2**quality.PLACE_BITS + int("1" + "".join(same[k : k + n]), 2))
    return sorted(found)


@pytest.mark.parametrize(
    "text", [None, "", "a", "ab", "abc d", "the the the cat", "ü€𝄞 ü€𝄞", " \n\t ", "x" * 50]
)
@pytest.mark.parametrize("slice_", [1, 3, 1 << 18])
def test_features(monkeypatch, text, slice_):
    monkeypatch.setattr(quality, "SLICE", slice_)
    assert quality.features(text).tolist() == plain_features(text)


def test_weights_are_optimal():
    """The hinge loss at the weights found is that of the dual, which bounds it from below."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8))
    good = x[:, 0] + 0.5 * rng.normal(size=60) > 0
    places = np.arange(8)
    cost = np.where(good, 0.7, 1.3)
    weights, bias = quality.descend([(places, row) for row in x], good, cost)
    w = np.append(weights[:8], bias)
    full = np.hstack([x, np.ones((60, 1))]) * np.where(good, 1, -1)[:, None]

    def loss(v):
        return v @ v / 2 + (cost * np.maximum(0, 1 - full @ v)).sum()

    # No step along any direction makes it smaller by more than what the passes leave.
    at = loss(w)
    for _ in range(500):
        v = rng.normal(size=9)
        for length in (0.01, 0.1, 0.5):
            assert loss(w + length * v) > at - 0.02 * at


def test_ratios():
    rows = [np.array([0, 1]), np.array([1]), np.array([1, 2])]
    found = quality.log_ratios(rows, np.array([True, True, False]))
    total = (quality.FEATURES + 3, quality.FEATURES + 2)
    assert found[0] == pytest.approx(np.log(2 / total[0]) - np.log(1 / total[1]))
    assert found[1] == pytest.approx(np.log(3 / total[0]) - np.log(2 / total[1]))
    assert found[2] == pytest.approx(np.log(1 / total[0]) - np.log(2 / total[1]))


def test_curve_gives_shares():
    """Margins that tell nothing give the share of the good class, weighed."""
    good = np.array([True] * 30 + [False] * 10)
    slope, offset = quality.logistic(np.zeros(40), good, np.where(good, 1.0, 3.0))
    assert 1 / (1 + np.exp(-offset)) == pytest.approx(0.5, abs=0.05)


def test_held_out_accuracy(spark):
    found = op11_quality(spark, SF).toPandas()
    assert list(found.columns) == ["doc_id", "held_out", "score", "predicted"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").toPandas()
    assert sorted(found.doc_id) == sorted(docs.doc_id)
    assert (found.predicted == (found.score >= 0.5)).all()
    assert found.score.between(0, 1).all()
    want = [zlib.crc32(str(i).encode()) % 3 == 1 for i in found.doc_id]
    assert found.held_out.tolist() == want
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    held = found[found.held_out].merge(labels, on="doc_id")
    for label in (0, 1):
        assert (held[held.quality == label].predicted == label).mean() >= 0.95


def rows_of(spark, tmp_path, docs, labels):
    schema = "doc_id long, text string, lang string, good int, place string, id int, score string"
    spark.createDataFrame([(*d, 1, "p", 2, "s") for d in docs], schema).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    found = op11_quality(spark, str(tmp_path)).collect()
    return sorted(((r.doc_id, r.held_out, r.score, r.predicted) for r in found), key=str)


def test_odd_rows(spark, tmp_path):
    """Nulls, empty and long texts, repeated ids, labels that disagree or have no document."""
    docs = [(k, "well written words" if k % 2 else "%% ## %% ##", "en") for k in range(60)]
    docs += [(None, "no id", None), (100, None, None), (101, "", "en"), (7, "other row", "en")]
    docs += [(102, "%% ## " * 200_000, "en")]
    labels = [(k, k % 2, 0, 1) for k in range(60)]
    labels += [(None, 1, 0, 1), (100, 1, 0, 1), (999, 0, 0, 1), (3, 1, 0, 1), (5, None, 0, 1)]
    labels += [(9, 0, 0, 1), (11, 7, 0, 1)]
    got = rows_of(spark, tmp_path, docs, labels)
    assert len(got) == len(docs)
    by_id = {}
    for doc_id, _, score, predicted in got:
        by_id.setdefault(doc_id, []).append((score, predicted))
    assert all(by_id[k][0][1] == k % 2 for k in range(60) if k != 7)
    assert by_id[102][0][1] == 0
    assert by_id[100][0] == by_id[101][0]
    assert got[-1][0] is None or any(r[0] is None and r[1] is False for r in got)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0, 1), (2, 1, 0, 1)], [(1, None, 0, 1)]])
def test_without_both_classes(spark, tmp_path, labels):
    """Every text has the share of the good class, which without labels is one half."""
    got = rows_of(spark, tmp_path, [(1, "a", "en"), (2, "b", "en"), (3, None, "en")], labels)
    want = (sum(r[1] == 1 and zlib.crc32(str(r[0]).encode()) % 3 != 1 for r in labels) + 1) / (
        sum(r[1] is not None and zlib.crc32(str(r[0]).encode()) % 3 != 1 for r in labels) + 2
    )
    assert [r[2] for r in got] == pytest.approx([want] * 3)


def test_empty_tables(spark, tmp_path):
    assert rows_of(spark, tmp_path, [], []) == []


def test_rare_class_and_order_of_rows(spark):
    """A rare class is drawn whole; the fit does not depend on how rows are dealt."""
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 380, "good words").otherwise("###").alias("text"),
    )
    labels = docs.select("doc_id", (F.col("doc_id") < 380).cast("int").alias("quality"))
    one = quality.train(docs, labels, sample=50)
    other = quality.train(docs.repartition(7, "text"), labels.repartition(3), sample=50)
    assert np.array_equal(one.weights, other.weights)
    assert one.score(quality.features("good words")) > 0.5 > one.score(quality.features("###"))
