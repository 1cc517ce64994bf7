"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of a block of texts lie in one flat symbol array. In every round each
sequence applies its own pair of the lowest rank, all sequences at once; a sequence without a
pair that merges is done, and its surviving symbols are its tokens.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncolake.llm.pretokens import blocks, bounds, number_words
from oncolake.llm.shared import extended, release_memory

#: Longer sequences are merged one by one with a heap: rounds would pass over them too often.
LONG = 400
NEVER = np.int32(2**31 - 1)


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Fixed rule: visible Latin-1 characters stand for themselves, the others for 256 upwards.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in set(visible))
    return {b: chr(b) for b in visible} | {b: chr(256 + n) for n, b in enumerate(others)}


class Merges:
    """Ranks of symbol pairs, looked up for whole arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.width = max(vocab.values()) + 1
        self.first = np.array([vocab[s] for _, s in sorted(byte_symbols().items())], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        if len(set(self.merged.tolist())) != len(pairs):
            raise ValueError("two merges make the same token: rounds could differ from steps")
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        self.slots = 1 << 20
        self._table(keys)
        self.rank_of = {int(k): r for r, k in enumerate(keys)}

    def _table(self, keys: np.ndarray) -> None:
        """Open addressing: a pair lies in the first free slot behind its hash."""
        self.key = np.full(self.slots, -1, np.int64)
        self.rank = np.full(self.slots, NEVER, np.int32)
        left, probe = np.arange(len(keys)), 0
        while len(left):
            slot = self._slot(keys[left], probe)
            free = self.key[slot] < 0
            _, one = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            take = one[free[one]]
            self.key[slot[take]], self.rank[slot[take]] = keys[left[take]], left[take]
            stays = np.ones(len(left), bool)
            stays[take] = False
            left, probe = left[stays], probe + 1
        self.probes = probe

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(44)).astype(np.int64) + probe) & (self.slots - 1)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        slot = self._slot(keys, 0)
        out = np.where(self.key[slot] == keys, self.rank[slot], NEVER)
        # A key that met another one may lie further on; a free slot ends the search.
        open_ = np.flatnonzero((out == NEVER) & (self.key[slot] >= 0))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            slot = self._slot(keys[open_], probe)
            hit = self.key[slot] == keys[open_]
            out[open_[hit]] = self.rank[slot[hit]]
            open_ = open_[~hit & (self.key[slot] >= 0)]
        return out

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each word."""
        out = np.zeros(len(words), np.int64)
        length = np.fromiter(map(len, words), np.int64, len(words))
        for k in np.flatnonzero(length > LONG).tolist():
            out[k] = self._count_long(words[k])
        of = np.flatnonzero((length > 0) & (length <= LONG))
        if not len(of):
            return out
        flat = np.frombuffer(b"".join([words[k] for k in of.tolist()]), np.uint8)
        symbols, length = self.first[flat], length[of]
        rank = self._fresh(symbols, length)
        while len(of):
            start = np.cumsum(length) - length
            lowest = np.minimum.reduceat(rank, start)
            done = lowest == NEVER
            if done.any():
                out[of[done]] = length[done]
                keep = np.repeat(~done, length)
                symbols, rank = symbols[keep], rank[keep]
                of, length, lowest = of[~done], length[~done], lowest[~done]
                continue
            at = np.flatnonzero(rank == np.repeat(lowest, length))
            # In a run of equal symbols every other pair is taken, from the left.
            if len(at) > 1:
                run = np.concatenate([[True], np.diff(at) != 1])
                place = np.arange(len(at))
                since = place - np.maximum.accumulate(np.where(run, place, 0))
                at = at[since % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            owner = np.searchsorted(np.cumsum(length), at, side="right")
            length = length - np.bincount(owner, minlength=len(length))
            # Only the pairs of a new symbol, with its left and its right neighbour, change.
            place = at - np.arange(len(at))
            symbols, rank = symbols[keep], rank[keep]
            end = np.zeros(len(symbols), bool)
            end[np.cumsum(length) - 1] = True
            touched = np.unique(np.concatenate([place, place[place > 0] - 1]))
            rank[touched] = NEVER
            touched = touched[~end[touched]]
            rank[touched] = self.ranks(symbols[touched], symbols[touched + 1])
        return out

    def _fresh(self, symbols: np.ndarray, length: np.ndarray) -> np.ndarray:
        rank = np.full(len(symbols), NEVER, np.int32)
        rank[:-1] = self.ranks(symbols[:-1], symbols[1:])
        rank[np.cumsum(length) - 1] = NEVER
        return rank

    def _count_long(self, word: bytes) -> int:
        """The same merges in one sequence: lowest rank first, then leftmost."""
        symbols = self.first[np.frombuffer(word, np.uint8)].tolist()
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        rank_of, width, merged = self.rank_of, self.width, self.merged
        queue = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (r := rank_of.get(symbols[i] * width + symbols[j])) is not None:
                heapq.heappush(queue, (r, i, symbols[i], symbols[j]))

        for i in range(n - 1):
            offer(i)
        left = n
        while queue:
            r, i, a, b = heapq.heappop(queue)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue
            symbols[i], symbols[j] = int(merged[r]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            left -= 1
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return left


@lru_cache(maxsize=2)
def _merges(path: str) -> Merges:
    return Merges(path)


def count_tokens(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = 1024,
) -> DataFrame:
    """Per row of `docs`: the id, n_bytes, n_tokens, and over_limit (n_tokens > max_tokens).

    `path` is a byte-level BPE file in JSON. Strings of its added tokens count as that one token
    each, as the tokenizer library has it. A null or empty text has 0 bytes and 0 tokens.
    Repeated rows are counted each; other columns are not carried on. Nothing is shuffled; a
    task holds one block of texts, or one longer text.
    """
    source = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    schema = extended(
        source.drop("__text"), n_bytes="long", n_tokens="long", over_limit="boolean"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _merges(path)
        for rows, texts in blocks(batches, 1):
            owner, pieces = _between_special(texts, merges.special)
            block = number_words(pieces, pattern)
            tokens = merges.counts([w.encode() for w in block.words])
            ends = bounds(tokens[block.numbers])[block.ends]
            # A text in several pieces has one added token between each two of them.
            total = np.bincount(owner, weights=np.diff(ends) + 1, minlength=len(texts)) - 1
            total = total.astype(np.int64)
            yield from pa.Table.from_arrays(
                [
                    rows.column(0),
                    pc.cast(pc.binary_length(texts), pa.int64()),
                    pa.array(total),
                    pa.array(total > max_tokens),
                ],
                names=schema.names,
            ).to_batches()
        release_memory()

    return source.mapInArrow(count, schema)


def _between_special(texts: pa.Array, special: list[str]) -> tuple[np.ndarray, pa.Array]:
    """The pieces of the texts between strings of added tokens, and whose pieces they are.

    The leftmost string cuts, of those at one place the longest.
    """
    owner = np.arange(len(texts))
    found = np.zeros(len(texts), bool)
    for string in special:
        found |= pc.match_substring(texts, string).to_numpy(zero_copy_only=False)
    if not found.any():
        return owner, texts
    cut = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))).split
    pieces = [cut(t) if f else [t] for t, f in zip(texts.to_pylist(), found, strict=True)]
    owner = np.repeat(owner, [len(p) for p in pieces])
    return owner, pa.array([piece for p in pieces for piece in p], pa.string())
