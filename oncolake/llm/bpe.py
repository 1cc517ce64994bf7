"""Byte-level BPE encoding and decoding through one shuffle of distinct words.

1. Every task cuts its texts into pre-tokens, numbers the distinct ones of a block of texts, and
   keeps each text as the sequence of these numbers, in the order of the text: the exploded
   pre-tokens with their positions, packed.
2. The distinct words of the blocks are shuffled by a hash of the word. What meets there is every
   occurrence of a word in any block, and each distinct word is encoded once.
3. The ids go back to the blocks, where every text is put together by position.

Numbers mean something within their block only. Blocks are made from the rows of an input
partition in their order, so that order must not change between two reads; `encode` writes its
input first unless told that it is a plain file scan. A check sum of the block's words, carried
both by the words and by the texts, stops the job should they ever differ.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncolake.llm.pretokens import blocks, bounds, number_words, pack, ragged, unpack
from oncolake.llm.shared import extended, release_memory, written

#: Ids of the texts that leave a task at once, at least.
OUT_IDS = 1_000_000

_WORDS = "block long, sum long, bucket int, words binary, sizes binary, numbers binary"
_DICTIONARY = "block long, sum long, kind int, numbers binary, sizes binary, data binary"


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a file of base64 and rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@lru_cache(maxsize=2)
def _word_encoder(path: str):
    """Ids of one word. The library merges one piece at a time; no text is matched by it."""
    core = tiktoken.Encoding(
        "ranks", pat_str=r"[\s\S]+", mergeable_ranks=read_ranks(path), special_tokens={}
    )
    return core._encode_single_piece


def _blocks_of(batches: Iterator[pa.RecordBatch], pattern: str):
    """(block, check sum, rows, words, numbered texts) of the rows of one input partition."""
    for k, (rows, texts) in enumerate(blocks(batches, 2)):
        numbered = number_words(texts, pattern).by_frequency()
        raw = [w.encode() for w in numbered.words]
        total = zlib.crc32(b"\0".join(raw)) * (1 << 24) + len(raw) % (1 << 24)
        yield (rows.column(0)[0].as_py() << 32) + k, total, rows, raw, numbered


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    stable_input: bool = False,
) -> DataFrame:
    """The id and `ids`, the token ids of the whole text, for every row of `docs`.

    `path` has the ranks, `pattern` matches the pre-tokens; each match is encoded by itself and
    nothing is special. A null or empty text has no ids. Repeated rows are encoded each; other
    columns are not carried on. `stable_input` says that `docs` is a plain scan of files.

    The shuffles carry a block's distinct words once, and the texts as one to three bytes for
    each pre-token. A frequent word is one row part for each block, whatever its count; a bucket
    of words is bounded by the number of distinct words over the shuffle partitions.
    """

    def ids_alone():
        return lambda keys, ids: pa.RecordBatch.from_arrays([keys, _column(ids)], ["key", "ids"])

    return _encoded(
        docs, path, pattern, id_col, text_col, stable_input, ids_alone, "ids array<int>"
    )


def _column(ids: list[np.ndarray]) -> pa.ListArray:
    ends = bounds(np.fromiter(map(len, ids), np.int64, len(ids)))
    values = np.concatenate(ids).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _encoded(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str,
    text_col: str,
    stable_input: bool,
    output: Callable[[], Callable[[pa.Array, list[np.ndarray]], pa.RecordBatch]],
    columns: str,
) -> DataFrame:
    """The encoded texts, as the function that `output` makes in each task gives them out."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    if not stable_input:
        source = written(source, "bpe-input")
    source = source.select(F.spark_partition_id().alias("part"), "key", "text")
    key = source.schema["key"]

    def split_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, total, _, words, _ in _blocks_of(batches, pattern):
            if not words:
                continue
            bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
            order = np.argsort(bucket, kind="stable")
            parts = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
            held = [[words[k] for k in part.tolist()] for part in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * len(parts), pa.int64()),
                    pa.array([total] * len(parts), pa.int64()),
                    pa.array([int(bucket[p[0]]) for p in parts], pa.int32()),
                    pa.array([b"".join(h) for h in held], pa.binary()),
                    pa.array([pack(np.fromiter(map(len, h), np.int64, len(h))) for h in held]),
                    pa.array([pack(np.diff(p, prepend=0)) for p in parts]),
                ],
                names=["block", "sum", "bucket", "words", "sizes", "numbers"],
            )
        release_memory()

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, ids, bucket = _word_encoder(path), {}, None
        for batch in batches:
            out_sizes, out_data = [], []
            for row in _rows(batch.select(["bucket", "words", "sizes"])):
                if row["bucket"] != bucket:
                    bucket, ids = row["bucket"], {}
                ends = bounds(unpack(row["sizes"])).tolist()
                found = []
                for a, b in zip(ends, ends[1:], strict=False):
                    word = row["words"][a:b]
                    got = ids.get(word)
                    if got is None:
                        got = ids[word] = one(word)
                    found.append(got)
                out_sizes.append(pack(np.fromiter(map(len, found), np.int64, len(found))))
                out_data.append(pack(np.fromiter(chain.from_iterable(found), np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([0] * batch.num_rows, pa.int32()),
                    batch.column(5),
                    pa.array(out_sizes, pa.binary()),
                    pa.array(out_data, pa.binary()),
                ],
                names=["block", "sum", "kind", "numbers", "sizes", "data"],
            )

    def split_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, total, rows, _, texts in _blocks_of(batches, pattern):
            n, ends = rows.num_rows, texts.ends.tolist()
            packed = [pack(texts.numbers[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
            nothing = pa.nulls(n, pa.binary())
            yield from pa.Table.from_arrays(
                [
                    pa.array([block] * n, pa.int64()),
                    pa.array([total] * n, pa.int64()),
                    pa.array([1] * n, pa.int32()),
                    nothing,
                    nothing,
                    pa.array(packed, pa.binary()),
                    rows.column(1),
                ],
                names=["block", "sum", "kind", "numbers", "sizes", "data", "key"],
            ).to_batches()
        release_memory()

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total, parts = None, None, []
        start = size = flat = None
        keys, out, filled = [], [], 0
        emit = output()
        for batch in batches:
            arrow_key = batch.schema.field("key").type
            for row in _rows(batch):
                if row["block"] != block:
                    block, total, parts, start = row["block"], row["sum"], [], None
                if row["sum"] != total:
                    raise RuntimeError(f"the texts of block {block} changed between two reads")
                if row["kind"] == 0:
                    parts.append((row["numbers"], row["sizes"], row["data"]))
                    continue
                if start is None:
                    start, size, flat = _dictionary(parts)
                    parts = []
                    if len(start) % (1 << 24) != total % (1 << 24):
                        raise RuntimeError(f"words of block {block} are missing")
                at = unpack(row["data"])
                keys.append(row["key"])
                out.append(flat[ragged(start[at], size[at])] if len(at) else flat[:0])
                filled += len(out[-1])
                if filled >= OUT_IDS:
                    yield emit(pa.array(keys, arrow_key), out)
                    keys, out, filled = [], [], 0
        if keys:
            yield emit(pa.array(keys, arrow_key), out)
        release_memory()

    dictionary = (
        source.mapInArrow(split_words, _WORDS)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(encode_words, _DICTIONARY)
        .withColumn("key", F.lit(None).cast(key.dataType))
    )
    texts = source.mapInArrow(
        split_texts, f"{_DICTIONARY}, key {key.dataType.simpleString()}"
    )
    return (
        texts.unionByName(dictionary)
        .repartition("block")
        .sortWithinPartitions("block", "kind")
        .mapInArrow(put_together, f"key {key.dataType.simpleString()}, {columns}")
        .withColumnRenamed("key", id_col)
    )


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, a few at a time, so that their values are not there twice at once."""
    for start in range(0, batch.num_rows, 256):
        yield from batch.slice(start, 256).to_pylist()


def _dictionary(parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and size of each word's ids by its number, and the ids of all."""
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none
    number = np.concatenate([np.cumsum(unpack(n)) for n, _, _ in parts])
    sizes = np.concatenate([unpack(s) for _, s, _ in parts])
    flat = np.concatenate([unpack(d) for _, _, d in parts])
    start, size = np.empty_like(number), np.empty_like(number)
    start[number], size[number] = bounds(sizes)[:-1], sizes
    return start, size, flat


def _lists(column: pa.ListArray) -> Iterator[list[int]]:
    """The rows of a list column; a null is an empty one."""
    values = column.values.to_numpy(zero_copy_only=False)
    ends = column.offsets.to_numpy().tolist()
    for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
        yield values[a:b].tolist() if column[k].is_valid else []


class _Decimals(dict):
    """The decimal text of each id met, made once."""

    def __missing__(self, number: int) -> str:
        text = self[number] = str(number)
        return text


def token_bytes(path: str) -> list[bytes | None]:
    """The bytes of every token by its id; None for an id that no token has."""
    ranks = read_ranks(path)
    table: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def decode(
    encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """The id, the ids, and `decoded`, the bytes that they stand for, of every row.

    The table of token bytes, whose size is that of the vocabulary file, is joined by id inside
    the task. Null ids decode to no bytes; an id outside of the table stops the job.
    """
    source = encoded.select(F.col(id_col), F.col(ids_col))
    schema = extended(source, decoded="binary")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        for batch in batches:
            texts = [_joined(table, ids) for ids in _lists(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.binary())], schema.names
            )

    return source.mapInArrow(join, schema)


def _joined(table: list[bytes | None], ids: list[int]) -> bytes:
    return b"".join(map(table.__getitem__, ids))


def round_trip(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    stable_input: bool = False,
) -> DataFrame:
    """`encode` and `decode` in one task: the id, `ids` and `decoded` of every row. A task then
    has one Python worker, whose output is what both would give."""

    def both():
        table = token_bytes(path)

        def emit(keys: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
            texts = [_joined(table, row.tolist()) for row in ids]
            columns = [keys, _column(ids), pa.array(texts, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["key", "ids", "decoded"])

        return emit

    columns = "ids array<int>, decoded binary"
    return _encoded(docs, path, pattern, id_col, text_col, stable_input, both, columns)


def digest(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    stable_input: bool = False,
) -> DataFrame:
    """`round_trip`, of which only digests leave the task: the id, n_tokens, and SHA-256 of the
    decimal ids and of the bytes that the ids decode to."""

    def hashed():
        table, decimal = token_bytes(path), _Decimals()

        def emit(keys: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
            counts, of_ids, of_bytes = [], [], []
            for row in map(np.ndarray.tolist, ids):
                text = " ".join(map(decimal.__getitem__, row))
                counts.append(len(row))
                of_ids.append(hashlib.sha256(text.encode()).hexdigest())
                of_bytes.append(hashlib.sha256(_joined(table, row)).hexdigest())
            return pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array(counts, pa.int64()),
                    pa.array(of_ids, pa.string()),
                    pa.array(of_bytes, pa.string()),
                ],
                ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return emit

    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _encoded(docs, path, pattern, id_col, text_col, stable_input, hashed, columns)
