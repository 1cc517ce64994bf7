"""Counts against the tokenizer library, and pre-tokens against the pattern."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from oncolake.llm import pretokens, token_counts
from oncolake.llm.queries import op8_token_counts

SF = "/root/testdata/sf0.01"
PATTERN = public_tokenizers.PATTERN
PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "a", "Hello  world\n it's", "a" * 3000, "ab" * 2500 + " c", "=" * 999,
    "x<|endoftext|>y <|endoftext|><|endoftext|>", "<|endoftext|>", "<|endoftext", "é中🙂\x1c ½ 　z",
]
ODD = st.text(st.sampled_from(list("aab \n\t's.,1²é中🙂<|>\x1c\x85　")), max_size=40)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("block", [pretokens.BLOCK_BYTES, 30])
def test_counts(spark, monkeypatch, library, block):
    monkeypatch.setattr(pretokens, "BLOCK_BYTES", block)
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", "y"), (3, "a", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = token_counts.count_tokens(docs, PATH, PATTERN, max_tokens=3)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(i, len((t or "").encode()), expected(library, t)) for i, t, _ in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        ((i, b, n, n > 3) for i, b, n in want), key=repr
    )
    assert token_counts.count_tokens(docs.limit(0), PATH, PATTERN).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD, max_size=5))
def test_pretokens_are_the_pattern_s(texts):
    found = pretokens.number_words(pa.array(texts, pa.string()), PATTERN).by_frequency()
    got = [
        [found.words[n] for n in found.numbers[a:b]]
        for a, b in zip(found.ends, found.ends[1:], strict=False)
    ]
    assert got == [pretokens.matcher(PATTERN).findall(t) for t in texts]


def test_pattern_that_takes_no_spaces():
    texts = ["a b  c", "", "x"]
    found = pretokens.number_words(pa.array(texts), r"\S+|\s+")
    assert [found.words[n] for n in found.numbers] == ["a", " ", "b", "  ", "c", "x"]
    assert found.ends.tolist() == [0, 5, 5, 6]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**60)))
def test_packed_numbers(numbers):
    array = np.array(numbers, np.int64)
    assert pretokens.unpack(pretokens.pack(array)).tolist() == numbers


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=30), max_size=20))
def test_rounds_and_heap_agree(words):
    merges = token_counts._merges(PATH)
    assert merges.counts(words).tolist() == [merges._count_long(w) for w in words]


def test_whole_table(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op8_token_counts(spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {
        i: (len(t.encode()), n := expected(library, t), n > 1024) for i, t in docs.items()
    }
    assert len(got) == len(docs)
