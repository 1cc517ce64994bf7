"""Pre-tokens of texts, as numbers of the distinct words of a block of texts.

A space between two characters that are not white space always starts a pre-token: no branch of
the pattern but its white-space runs can hold a space behind its first character. So texts are
cut at their spaces, the chunks are numbered as one dictionary array, and the pattern runs once
over the distinct chunks of a block. Texts where a space touches other white space are matched as
a whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Texts of a block hold so many bytes, or are one longer text.
BLOCK_BYTES = 8_000_000
#: The cut at spaces holds for this family of patterns, known by how they take a space.
_SPACE_RULE = (r" ?\p{L}+", r" ?\p{N}+", r" ?[^\s\p{L}\p{N}]+", r"\s+(?!\S)", r"\s+")


@lru_cache(maxsize=4)
def matcher(pattern: str) -> regex.Pattern:
    """The pattern with white space as Unicode defines it, as the tokenizer libraries have it."""
    spelled = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    return regex.compile(spelled)


@lru_cache(maxsize=4)
def _by_space(pattern: str) -> bool:
    branches = pattern.split("|")
    return all(b in _SPACE_RULE or not regex.search(r"[\s\\\[(]", b) for b in branches)


def bounds(sizes: np.ndarray) -> np.ndarray:
    """Where stretches of these sizes begin and end."""
    return np.concatenate([[0], np.cumsum(sizes)])


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of stretches, one after the other."""
    return np.repeat(start - bounds(size)[:-1], size) + np.arange(int(size.sum()))


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


@dataclass
class Numbered:
    """Texts as numbers of words: text k has numbers[ends[k]:ends[k + 1]]."""

    words: list[str]
    numbers: np.ndarray
    ends: np.ndarray

    def by_frequency(self) -> Numbered:
        """The same with the most frequent words first, ties in order of appearance, and
        without words that no text holds."""
        count = np.bincount(self.numbers, minlength=len(self.words))
        order = np.argsort(-count, kind="stable")[: int((count > 0).sum())]
        place = np.zeros(len(self.words), np.int64)
        place[order] = np.arange(len(order))
        return Numbered([self.words[k] for k in order.tolist()], place[self.numbers], self.ends)


def number_words(texts: pa.Array, pattern: str) -> Numbered:
    """The pre-tokens of texts that are not null."""
    find = matcher(pattern).findall
    if _by_space(pattern):
        return _numbered_by_space(texts, find)
    found = [find(t) for t in texts.to_pylist()]
    words = pa.array([w for f in found for w in f], pa.string()).dictionary_encode()
    ends = bounds(np.fromiter(map(len, found), np.int64, len(found)))
    return Numbered(_strings(words.dictionary), words.indices.to_numpy().astype(np.int64), ends)


def _numbered_by_space(texts: pa.Array, find) -> Numbered:
    parts = pc.split_pattern(texts, " ")
    start = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.values.slice(start[0], start[-1] - start[0]).dictionary_encode()
    start -= start[0]
    first, last = start[:-1], start[1:] - 1
    part = coded.indices.to_numpy().astype(np.int64)
    chunks = _strings(coded.dictionary)
    empty = np.fromiter((not c for c in chunks), bool, len(chunks))
    opens = np.fromiter((c[:1].isspace() for c in chunks), bool, len(chunks)) | empty
    closes = np.fromiter((c[-1:].isspace() for c in chunks), bool, len(chunks)) | empty

    # A part must touch its spaces with characters that are not white space.
    bad = opens[part] | closes[part]
    bad[first] = closes[part[first]] & ~empty[part[first]]
    bad[last] = np.where(first == last, False, opens[part[last]])
    whole = np.add.reduceat(bad, first) > 0 if len(first) else np.zeros(0, bool)

    # Units are what the pattern is run on: clean chunks behind a space, and single strings.
    clean = np.flatnonzero(~(opens | closes))
    tokens = find(" " + " ".join([chunks[k] for k in clean.tolist()])) if len(clean) else []
    begins = [k for k, t in enumerate(tokens) if t[0] == " "]
    if len(begins) != len(clean):
        raise ValueError("the pattern joins words across a space")
    sizes = np.diff(begins, append=len(tokens)).tolist()
    unit = np.full(len(chunks), len(sizes), np.int64)
    unit[clean] = np.arange(len(clean))
    sizes.append(0)  # the unit without tokens
    units = unit[part]
    units[np.repeat(whole, np.diff(start))] = len(sizes) - 1

    def single(place: int, text: str) -> None:
        found = find(text)
        tokens.extend(found)
        units[place] = len(sizes)
        sizes.append(len(found))

    for k in np.flatnonzero(whole).tolist():
        single(first[k], texts[k].as_py())
    for k in np.flatnonzero(~whole & ~empty[part[first]]).tolist():
        single(first[k], chunks[part[first[k]]])
    for k in np.flatnonzero(~whole & (first != last) & closes[part[last]]).tolist():
        single(last[k], " " + chunks[part[last[k]]])

    words = pa.array(tokens, pa.string()).dictionary_encode()
    size = np.array(sizes, np.int64)
    at = ragged(bounds(size)[:-1][units], size[units])
    numbers = words.indices.to_numpy().astype(np.int64)[at]
    return Numbered(_strings(words.dictionary), numbers, bounds(size[units])[start])


def blocks(
    batches: Iterable[pa.RecordBatch], column: int
) -> Iterator[tuple[pa.Table, pa.Array]]:
    """Rows in blocks of about BLOCK_BYTES of text, in their order, and the texts, null as ''."""
    held: list[pa.RecordBatch] = []
    filled = 0

    def block():
        rows = pa.Table.from_batches(held)
        return rows, pc.fill_null(rows.column(column).combine_chunks().cast(pa.string()), "")

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = int(np.searchsorted(ends, before + BLOCK_BYTES - filled)) + 1
            stop = min(max(stop, at + 1), batch.num_rows)
            held.append(batch.slice(at, stop - at))
            filled += int(ends[stop - 1] - before)
            at = stop
            if filled >= BLOCK_BYTES:
                yield block()
                held, filled = [], 0
    if held:
        yield block()


def pack(numbers: np.ndarray) -> bytes:
    """Numbers of 0 or more as groups of 7 bits, lowest first, the last below 128."""
    v = numbers.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 9):
        size += v >= np.uint64(1) << np.uint64(7 * k)
    end = np.cumsum(size)
    out = np.zeros(int(end[-1]) if len(v) else 0, np.uint8)
    start = end - size
    for k in range(int(size.max()) if len(v) else 0):
        has = size > k
        group = (v[has] >> np.uint64(7 * k)) & np.uint64(127)
        out[start[has] + k] = group | np.where(size[has] > k + 1, np.uint64(128), np.uint64(0))
    return out.tobytes()


def unpack(data: bytes) -> np.ndarray:
    """The numbers of `pack`."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    end = np.flatnonzero(raw < 128)
    start = np.concatenate([[0], end[:-1] + 1])
    shift = 7 * (np.arange(len(raw)) - np.repeat(start, end - start + 1))
    return np.add.reduceat((raw & 127).astype(np.int64) << shift, start)
