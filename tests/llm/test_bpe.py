"""Encoding against the tokenizer library, and decoding back."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import tiktoken

from oncolake.llm import bpe, pretokens
from oncolake.llm.queries import op4_byte_bpe

SF = "/root/testdata/sf0.01"
PATTERN = public_tokenizers.PATTERN
NAMES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]
TEXTS = [
    "Hello world, it's  me.\n\nTabs\tand   spaces ", " lead", "trail ", "", None, " ", "\n", "a",
    "x" * 5000, "=" * 3000 + " y", "naïve café 中文字 🙂‍👩 ½²٣ \x1c\x1d \x85　z", "<|endoftext|> a",
    "Hello world, it's  me.\n\nTabs\tand   spaces ", "we'll we 'll I'Ve", "  a  b",
]


def library(name):
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path(name)),
        special_tokens={},
    )


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("block", [pretokens.BLOCK_BYTES, 40])
def test_round_trip(spark, monkeypatch, name, block):
    monkeypatch.setattr(pretokens, "BLOCK_BYTES", block)
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", None), (0, TEXTS[0], "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    path, reference = public_tokenizers.path(name), library(name)
    encoded = bpe.encode(docs, path, PATTERN)
    assert encoded.columns == ["doc_id", "ids"]
    got = bpe.decode(encoded, path).collect()
    want = sorted(((i, reference.encode_ordinary(t or ""), t or "") for i, t, _ in rows), key=repr)
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded).decode()) for r in got), key=repr) == want


def test_ids_of_other_types_and_empty_tables(spark):
    path = public_tokenizers.path(NAMES[0])
    docs = spark.createDataFrame([("k1", "one two"), ("k2", None)], "doc_id string, text string")
    assert {r.doc_id: len(r.ids) for r in bpe.encode(docs, path, PATTERN).collect()} == {"k1": 2, "k2": 0}
    assert bpe.encode(docs.limit(0), path, PATTERN).collect() == []


def test_null_and_unknown_ids(spark):
    path = public_tokenizers.path(NAMES[0])
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {bytes(r.decoded) for r in bpe.decode(rows, path).collect()} == {b""}
    bad = spark.createDataFrame([(1, [60_000])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="IndexError"):
        bpe.decode(bad, path).collect()


def test_whole_table(spark):
    reference = library(NAMES[0])
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op4_byte_bpe(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        ids = reference.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
