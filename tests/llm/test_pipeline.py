"""The pipeline against its stages' brute-force versions, and the registered queries."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as contract
import corpus_pipeline
from oncolake.llm import bpe, language
from oncolake.llm.queries import ORACLES, PSEUDONYM_KEY, QUERIES
from tests.llm.test_decontaminate import brute as brute_contamination
from tests.llm.test_language import brute_phrases
from tests.llm.test_near_copies import brute as brute_near_copies
from tests.llm.test_pii import pseudonymized
from tests.test_oracle import _rows

SF = "/root/testdata/sf0.001"


def brute_language(spark, docs):
    sample = language.labelled_sample(spark.read.parquet(f"{SF}/documents.parquet"))
    seen = {c for t in sample.values() for c in t.lower() if c.isalpha()}
    kept = []
    for row in docs:
        if not any(map(str.isalpha, row.text or "")):
            continue
        text = row.text.lower()
        fewest = min(brute_phrases(text, t, seen) for t in sample.values())
        if len(row.text) < language.LEAST_CHARS or len(text) / fewest >= language.LEAST_PHRASE_CHARS:
            kept.append(row)
    return kept


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that each stage left."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    folder = tmp_path_factory.mktemp("stages")
    out.append(docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs.collect())
    return out


def key(rows):
    return sorted(map(tuple, rows))


def test_languages(spark, stages):
    assert key(stages[1]) == key(brute_language(spark, stages[0]))


def test_near_duplicates(stages):
    """Near copies are those of five-word shingles, of which documents 1 and 177 are two."""
    first = brute_near_copies([(r.doc_id, r.text) for r in stages[1]])
    assert key(stages[2]) == key(r for r in stages[1] if r.doc_id in first)
    assert len(stages[2]) < len(stages[1])
    assert {1, 177} & {r.doc_id for r in stages[2]} == {1}


def test_decontamination(stages):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    dirty = {r[0] for r in brute_contamination([(r.doc_id, r.text) for r in stages[2]], items) if r[-1]}
    assert key(stages[3]) == key(r for r in stages[2] if r.doc_id not in dirty)
    assert dirty


def test_pseudonyms(stages):
    want = []
    for r in stages[3]:
        text = pseudonymized(PSEUDONYM_KEY, r.text)[0]
        want.append((r.doc_id, text, r.lang, r.source, len(text)))
    assert key(stages[4]) == sorted(want)
    assert key(stages[4]) != key(stages[3])


def test_encoding(stages):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={}
    )
    got = {r.doc_id: r for r in stages[5]}
    assert len(got) == len(stages[5]) == len(stages[4])
    for r in stages[4]:
        ids = library.encode_ordinary(r.text)
        assert (got[r.doc_id].ids, got[r.doc_id].n_tokens, got[r.doc_id].text) == (ids, len(ids), r.text)


def test_run_is_the_stages(spark, stages):
    assert key(corpus_pipeline.run(spark, SF).collect()) == key(stages[5])


def test_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in QUERIES) == 1 for n in names)
    assert set(contract.queries()) >= {*QUERIES, "pipeline"}
    assert set(contract.oracle_sql()) >= set(ORACLES)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, name):
    folder = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    duck = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got = QUERIES[name](spark, folder)
    want = duck.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.columns, got.collect()) == _rows(columns, want.fetchall())
