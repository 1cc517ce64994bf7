"""Language identification by cross-parsing entropy.

For every language a suffix automaton holds one labelled text. A text is parsed against each
automaton greedily: a phrase is the longest next stretch that occurs in the labelled text. The
language that needs the fewest phrases, each weighed with the bits it takes to point into that
language's text, wins.

Texts are parsed whole. Parsing is cut every PIECE characters, alike for all languages, so that
thousands of pieces advance one character at a time as numpy arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oncolake.llm.shared import extended, release_memory

#: Bounds of the labelled sample: documents of a language, characters of each, characters of all.
TRAIN_DOCS = 64
TRAIN_DOC_CHARS = 4_000
TRAIN_CHARS = 32_000

PIECE = 256
#: Rows of a batch that are parsed at once.
SLICE = 1_000
BLOCK_CHARS = 4_096 * PIECE
UNDETERMINED = "und"

#: A text is in none of the languages if phrases of the best one are shorter than this on
#: average. Texts of fewer characters are too short to tell, and are taken as they come.
LEAST_PHRASE_CHARS = 1.8
LEAST_CHARS = 20

SPACE = 1  # class of everything that is no letter; 0 stands behind the end of a piece


def labelled_sample(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_docs: int = TRAIN_DOCS,
    doc_chars: int = TRAIN_DOC_CHARS,
    max_chars: int = TRAIN_CHARS,
) -> dict[str, str]:
    """Text of each language, from the documents of the smallest hash of the id.

    The bound of the rows is `max_docs` for each language; it is kept inside every task before
    anything is shuffled. Rows without text or language are left out.
    """
    ranked = (
        docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
        .select(
            F.col(lang_col).alias("lang"),
            F.substring(text_col, 1, doc_chars).alias("text"),
            F.xxhash64(F.col(id_col)).alias("order"),
        )
        .withColumn(
            "rank", F.row_number().over(Window.partitionBy("lang").orderBy("order", "text"))
        )
        .filter(F.col("rank") <= max_docs)
    )
    found: dict[str, str] = {}
    for row in ranked.orderBy("lang", "rank").collect():
        held = found.get(row.lang, "")
        if len(held) < max_chars:
            found[row.lang] = (held + "\n" + row.text)[:max_chars]
    return {lang: text for lang, text in found.items() if any(c.isalpha() for c in text)}


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _automaton(classes: list[int], width: int) -> np.ndarray:
    """Transitions of the suffix automaton, a row for each state, -1 where there is none."""
    steps: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in classes:
        new = len(steps)
        steps.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at != -1 and c not in steps[at]:
            steps[at][c] = new
            at = link[at]
        if at != -1:
            to = steps[at][c]
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                twin = len(steps)
                steps.append(dict(steps[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at != -1 and steps[at].get(c) == to:
                    steps[at][c] = twin
                    at = link[at]
                link[to] = link[new] = twin
        last = new
    table = np.full((len(steps), width), -1, np.int32)
    for state, out in enumerate(steps):
        table[state, list(out.keys())] = list(out.values())
    return table


class Model:
    """The automata of all languages in one transition table, and the classes of characters.

    `steps` holds row offsets instead of state numbers; offset 0 is a row without transitions,
    which is where a parse stands before its first character.
    """

    def __init__(self, sample: tuple[tuple[str, str], ...]):
        self.langs = [lang for lang, _ in sample]
        texts = [_codes(text.lower()) for _, text in sample]
        letters = _letters()
        seen = np.unique(np.concatenate(texts)) if texts else np.zeros(0, np.uint32)
        seen = seen[letters[seen]]
        other = SPACE + 1 + len(seen)
        width = other + 1
        kind = np.uint8 if width <= 256 else np.uint32
        self.classes = np.where(letters, other, SPACE).astype(kind)
        self.classes[seen] = np.arange(SPACE + 1, other)
        tables, self.bits, base = [np.zeros((1, width), np.int32)], [], 1
        starts = np.zeros((len(texts), width), np.int64)
        for k, codes in enumerate(texts):
            mapped = self.classes[codes]
            keep = np.ones(len(mapped), bool)
            keep[1:] = (mapped[1:] != SPACE) | (mapped[:-1] != SPACE)
            mapped = mapped[keep]
            table = _automaton(mapped.tolist(), width)
            if (base + len(table)) * width >= 2**31:
                raise ValueError("the labelled texts of all languages are too long together")
            tables.append(np.where(table < 0, 0, (table + base) * width).astype(np.int32))
            starts[k] = tables[-1][0]
            self.bits.append(max(1.0, float(np.log2(max(2, len(mapped))))))
            base += len(table)
        self.steps = np.concatenate(tables).ravel()
        self.starts = starts.astype(np.int32)

    def phrases(self, segments: list[str]) -> np.ndarray:
        """Phrases of each segment against each language: an array segments x languages.

        A segment must start at a multiple of PIECE of its text.
        """
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        codes = _codes("".join(segments))
        pieces = -(-lengths // PIECE)
        first = np.cumsum(pieces) - pieces
        offset = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        piece = np.repeat(first, lengths) + offset // PIECE
        classes = self.classes[codes]
        keep = np.ones(len(classes), bool)
        keep[1:] = (
            (classes[1:] != SPACE) | (classes[:-1] != SPACE) | (piece[1:] != piece[:-1])
        )
        classes, piece = classes[keep], piece[keep]
        total = int(pieces.sum())
        sizes = np.bincount(piece, minlength=total)
        order = np.argsort(-sizes, kind="stable")
        place = np.empty(total, np.int64)
        place[order] = np.arange(total)
        at = np.arange(len(classes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        grid = np.zeros((PIECE, total), self.classes.dtype)
        grid[at, place[piece]] = classes
        live = np.searchsorted(-sizes[order], -np.arange(PIECE), side="left")
        count = np.zeros((len(self.langs), total), np.int32)
        state = np.zeros((len(self.langs), total), self.steps.dtype)
        for j in range(PIECE):
            m = int(live[j])
            if not m:
                break
            c = grid[j, :m]
            now = state[:, :m]
            to = self.steps.take(now + c)
            miss = to == 0
            count[:, :m] += miss
            state[:, :m] = np.where(miss, self.starts.take(c, axis=1), to)
        of = np.repeat(np.arange(len(segments)), pieces)
        out = np.zeros((len(segments), len(self.langs)), np.int64)
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(of, weights=count[k, place], minlength=len(segments))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, score and phrase length of each text.

        The score is the saving of the best language against the runner-up; the phrase length
        is the characters of a phrase in the best language, on average.
        """
        lowered = [t.lower() if t else "" for t in texts]
        totals = np.zeros((len(texts), len(self.langs)), np.int64)
        held: list[str] = []
        owners: list[int] = []
        filled = 0

        def flush() -> None:
            if held:
                np.add.at(totals, owners, self.phrases(held))
            held.clear()
            owners.clear()

        for k, text in enumerate(lowered):
            for start in range(0, len(text), BLOCK_CHARS):
                held.append(text[start : start + BLOCK_CHARS])
                owners.append(k)
                filled += len(held[-1])
                if filled >= BLOCK_CHARS:
                    flush()
                    filled = 0
        flush()
        langs, scores, lengths = [], [], []
        cost = totals * np.array(self.bits)
        for k, text in enumerate(lowered):
            if not self.langs or not any(map(str.isalpha, text)):
                langs.append(UNDETERMINED)
                scores.append(0.0)
                lengths.append(0.0)
                continue
            best = int(np.argmin(cost[k]))
            rest = np.delete(cost[k], best)
            second = float(rest.min()) if len(rest) else 0.0
            langs.append(self.langs[best])
            scores.append(1.0 if not len(rest) else (second - float(cost[k, best])) / second)
            lengths.append(len(text) / int(totals[k, best]))
        return langs, scores, lengths


@lru_cache(maxsize=2)
def _model(sample: tuple[tuple[str, str], ...]) -> Model:
    """Built once in a Python worker from the sample's texts."""
    return Model(sample)


def predict_language(
    docs: DataFrame,
    sample: dict[str, str],
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The id, the columns of `keep`, lang_pred, score and phrase_chars of every row of `docs`.

    A null or empty text, one without letters, and any text if the sample is empty: 'und' with
    score and phrase_chars 0. Of languages with equal cost the first by name wins, with score 0.
    Repeated rows are predicted alike. Other columns are not carried on. Nothing is shuffled;
    every task builds the automata of the bounded sample for itself.
    """
    pairs = tuple(sorted(sample.items()))
    columns = [F.col(id_col), *(F.col(c) for c in keep)]
    source = docs.select(*columns, F.col(text_col).alias("__text"))
    schema = extended(
        source.drop("__text"), lang_pred="string", score="double", phrase_chars="double"
    )

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(pairs)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                langs, scores, lengths = model.predict(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in range(part.num_columns - 1)),
                        pa.array(langs, pa.string()),
                        pa.array(scores, pa.float64()),
                        pa.array(lengths, pa.float64()),
                    ],
                    names=schema.names,
                )
        release_memory()

    return source.mapInArrow(predict, schema)


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2):
    """Whether a document is kept for testing; a null id is not."""
    return F.coalesce(
        F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False)
    )


def in_known_language(
    docs: DataFrame, sample: dict[str, str], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` whose text has letters and is in one of the sample's languages."""
    row = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*docs.columns).alias("row")
    )
    found = predict_language(row, sample, "id", "text", keep=("row",))
    known = (F.col("phrase_chars") >= LEAST_PHRASE_CHARS) | (
        F.length(F.col("row")[text_col]) < LEAST_CHARS
    )
    return found.filter((F.col("lang_pred") != UNDETERMINED) & known).select(
        *(F.col("row")[c].alias(c) for c in docs.columns)
    )
