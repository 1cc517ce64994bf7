"""Phrases against a plain search, and held-out accuracy."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from oncolake.llm import language
from oncolake.llm.queries import op10_language_id

SF = "/root/testdata/sf0.1"
SAMPLE = {
    "aa": "the cat sat on the mat and the dog ran off with the hat",
    "bb": "le chat était assis sur le tapis et le chien est parti avec",
}


def classes(text, seen):
    """Letters of the sample, one mark for other letters, runs of the rest as one space."""
    out = []
    for c in text.lower():
        c = (c if c in seen else "\0") if c.isalpha() else " "
        if not (c == " " and out and out[-1] == " "):
            out.append(c)
    return "".join(out)


def brute_phrases(text, train, seen):
    known = classes(train, seen)
    count = 0
    for start in range(0, len(text), language.PIECE):
        piece = classes(text[start : start + language.PIECE], seen)
        at = 0
        while at < len(piece):
            size = 1
            while at + size < len(piece) and piece[at : at + size + 1] in known:
                size += 1
            at += size
            count += 1
    return count


@pytest.mark.parametrize("block", [language.BLOCK_CHARS, language.PIECE])
def test_phrases(monkeypatch, block):
    monkeypatch.setattr(language, "BLOCK_CHARS", block)
    model = language.Model(tuple(sorted(SAMPLE.items())))
    seen = {c for t in SAMPLE.values() for c in t.lower() if c.isalpha()}
    texts = ["the cat and the dog", "LE CHAT!! est   parti", "xyz 12", "中文 the", "a", "  the ",
             "the cat sat on le tapis " * 60, "q" * 600]
    langs, scores, lengths = model.predict(texts)
    for k, text in enumerate(texts):
        want = [brute_phrases(text.lower(), SAMPLE[lang], seen) for lang in model.langs]
        cost = np.array(want) * np.array(model.bits)
        assert langs[k] == model.langs[int(np.argmin(cost))]
        assert lengths[k] == pytest.approx(len(text) / want[int(np.argmin(cost))])
        assert scores[k] == pytest.approx(1 - cost.min() / cost.max())


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_edge_rows(spark):
    rows = [(1, None, "aa", "x"), (2, "", None, "x"), (3, "12 !", "bb", "x"), (None, "the cat", None, None),
            (4, "le chat " * 50_000, None, "x"), (4, "le chat " * 50_000, None, "x")]
    found = language.predict_language(docs_of(spark, rows), SAMPLE).collect()
    got = sorted((r.doc_id or 0, r.lang_pred, r.score > 0) for r in found)
    assert got == [(0, "aa", True), (1, "und", False), (2, "und", False), (3, "und", False),
                   (4, "bb", True), (4, "bb", True)]
    none = language.predict_language(docs_of(spark, rows), {}).collect()
    assert {r.lang_pred for r in none} == {"und"}
    one = language.predict_language(docs_of(spark, rows), {"aa": SAMPLE["aa"]}).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("und", 0.0), ("aa", 1.0)}
    assert language.predict_language(docs_of(spark, []), SAMPLE).collect() == []


def test_sample_is_bounded(spark):
    rows = [(i, f"text {i} words", "aa" if i % 3 else "bb", "") for i in range(300)]
    rows += [(900, "12 34", "cc", ""), (901, None, "dd", ""), (902, "word", None, "")]
    sample = language.labelled_sample(docs_of(spark, rows), max_docs=5, doc_chars=6, max_chars=20)
    assert sample.keys() == {"aa", "bb"}
    assert all(0 < len(t) <= 20 for t in sample.values())
    assert language.labelled_sample(docs_of(spark, [])) == {}


def test_unknown_languages_go(spark):
    rows = [(1, "the dog and the cat sat with the hat", None, "x"), (2, "中文文本没有空格可以识别这是一个测试文件", None, "x"),
            (3, "1234", None, "x"), (4, None, None, "x"), (5, "Zz", None, "x")]
    kept = language.in_known_language(docs_of(spark, rows), SAMPLE)
    assert kept.columns == ["doc_id", "text", "lang", "score"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5]


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op10_language_id(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got} <= set(docs.values())
    held = [r.lang_pred == docs[r.doc_id] for r in got if r.held_out]
    assert np.mean(held) > 0.97
