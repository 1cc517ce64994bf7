"""Quality scores from support vectors over naive Bayes features.

A text is the set of its byte n-grams, hashed to a fixed number of places, and of the n-grams of
its words' repeats (whether a word equals the one before it). Each n-gram's weight is the log of
the ratio of its shares among good and bad documents; a text's vector has these weights where its
n-grams are, scaled to length one. A linear model with hinge loss is fitted to such vectors by
dual coordinate descent, and its margins become probabilities by a logistic curve fitted to margins
of documents that it was not fitted to.

Only the fit is bounded: by SAMPLE documents of each class, drawn by a hash of their ids. Scoring
reads whole texts, a row at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oncolake.llm.shared import checkpointed, extended, release_memory

#: Documents of each class that a model is fitted to, at most.
SAMPLE = 2_048
#: Longest n-grams, in bytes or words, and places that those of bytes are hashed to. Behind them
#: each n-gram of repeats has a place of its own.
LONGEST = 4
PLACE_BITS = 18
FEATURES = (1 << PLACE_BITS) + (2 << LONGEST)
#: Bytes of a text that are hashed at once.
SLICE = 1 << 18
#: Count added to each n-gram in both classes; bound of the dual variables; passes; share of the
#: sample that the curve is fitted to.
SMOOTHING = 1.0
COST = 1.0
PASSES = 20
CURVE_SHARE = 4


def _byte_grams(raw: np.ndarray) -> list[np.ndarray]:
    found = []
    for at in range(0, len(raw), SLICE):
        part = raw[at : at + SLICE + LONGEST - 1]
        value = np.zeros(len(part), np.uint64)
        for k in range(min(LONGEST, len(part))):
            value = value[: len(part) - k] * np.uint64(257) + part[k:] + np.uint64(1)
            # Those that start in this slice.
            mixed = value[:SLICE] * np.uint64(0x9E3779B97F4A7C15)
            found.append(np.unique(mixed >> np.uint64(64 - PLACE_BITS)).astype(np.int64))
    return found


def _repeat_grams(words: list[str]) -> list[np.ndarray]:
    same = np.fromiter(map(eq, words, islice(words, 1, None)), bool).astype(np.int64)
    found, value = [], np.ones(len(same), np.int64)
    for k in range(min(LONGEST, len(same))):
        value = value[: len(same) - k] * 2 + same[k:]
        found.append(np.unique(value) + (1 << PLACE_BITS))
    return found


def features(text: str | None) -> np.ndarray:
    """Sorted places of the n-grams of a text; a null text counts as empty."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint64)
    found = _byte_grams(raw) + _repeat_grams(text.split())
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


@dataclass(frozen=True)
class Model:
    """Log-count ratios, the weights on them with those of the bias, and the logistic curve."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, places: np.ndarray) -> float:
        held = self.ratios[places]
        length = float(np.sqrt(held @ held))
        return self.bias + (float(held @ self.weights[places]) / length if length else 0.0)

    def score(self, places: np.ndarray) -> float:
        """Between 0 and 1, higher where the good class is likelier."""
        z = self.slope * self.margin(places) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -700, 700))))


def log_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Log of each n-gram's share among good documents over its share among bad ones."""
    shares = []
    for label in (True, False):
        counts = np.full(FEATURES, SMOOTHING)
        for k in np.flatnonzero(good == label):
            counts[rows[k]] += 1
        shares.append(np.log(counts / counts.sum()))
    return shares[0] - shares[1]


def descend(
    rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, cost: np.ndarray
) -> tuple[np.ndarray, float]:
    """Weights and bias of the least hinge loss, by coordinate descent on its dual.

    A row is (places, values), `cost` the upper bound of its dual variable. Each step solves one
    variable exactly and moves the weights with it; the bias is the weight of a constant one.
    """
    weights, bias = np.zeros(FEATURES), 0.0
    sign = np.where(good, 1.0, -1.0)
    dual = np.zeros(len(rows))
    size = np.array([float(v @ v) + 1.0 for _, v in rows])
    rng = np.random.default_rng(7)
    for _ in range(PASSES):
        for k in rng.permutation(len(rows)):
            places, values = rows[k]
            slack = sign[k] * (float(weights[places] @ values) + bias) - 1.0
            to = min(max(dual[k] - slack / size[k], 0.0), cost[k])
            step = (to - dual[k]) * sign[k]
            if step:
                dual[k] = to
                weights[places] += step * values
                bias += step
    return weights, bias


def logistic(margins: np.ndarray, good: np.ndarray, share: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through margins, rows weighed by `share`.

    Newton steps on the likelihood, with targets kept off 0 and 1 so that it has a maximum.
    """
    n_good, n_bad = good.sum(), (~good).sum()
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    x = np.stack([margins, np.ones(len(margins))])
    at = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -700, 700)))
        slope = x @ (share * (p - target)) + 1e-6 * at
        bend = (x * (share * p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        at = at - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    # A curve that falls would say that the model is worse than none.
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1e-6, float(at[1]))


def fit(rows: list[np.ndarray], good: np.ndarray, classes: tuple[int, int]) -> Model:
    """A model of feature rows and their labels; `classes` are the sizes of (bad, good) whole.

    Every CURVE_SHARE-th row of each class is kept for the curve. Without rows of both classes the
    score is the share of the good class for every text.
    """
    bad_size, good_size = max(classes[0], 1), max(classes[1], 1)
    prior = float(np.log(good_size / bad_size))
    if not good.any() or good.all():
        prior = float(np.log((classes[1] + 1) / (classes[0] + 1)))
        return Model(np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 1.0, prior)
    rank = np.zeros(len(rows), np.int64)
    for label in (True, False):
        rank[good == label] = np.arange((good == label).sum())
    own = rank % CURVE_SHARE == CURVE_SHARE - 1
    if not (own & good).any() or not (own & ~good).any():
        own = np.ones(len(rows), bool)
    use = ~own if not own.all() else own
    chosen = np.flatnonzero(use)
    ratios = log_ratios([rows[k] for k in chosen], good[chosen])

    def scaled(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values = ratios[places]
        length = np.sqrt(values @ values)
        return places, values / length if length else values

    # Both classes weigh alike in the fit, whatever their parts of the sample are.
    counts = np.array([(~good[chosen]).sum(), good[chosen].sum()])
    cost = COST * len(chosen) / 2 / counts[good[chosen].astype(int)]
    weights, bias = descend([scaled(rows[k]) for k in chosen], good[chosen], cost)
    model = Model(ratios, weights, bias, 1.0, 0.0)
    held = np.flatnonzero(own)
    margins = np.array([model.margin(rows[k]) for k in held])
    sampled = np.array([(~good[held]).sum(), good[held].sum()])
    share = (np.array([bad_size, good_size]) / sampled)[good[held].astype(int)]
    slope, offset = logistic(margins, good[held], share * len(held) / share.sum())
    return Model(ratios, weights, bias, slope, offset)


# -- the sample and the model


def usable_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(id, good) of ids whose labels, 0 or 1, agree; others and null ids are left out."""
    return (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min(label_col).alias("low"), F.max(label_col).alias("high"))
        .filter(F.col("low") == F.col("high"))
        .select("id", (F.col("low") == 1).alias("good"))
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> Model:
    """A model of the labelled documents: of up to `sample` of each class, by a hash of the id.

    Documents without a text take no part. Of rows that repeat an id one counts, chosen by its
    text. The labelled ids are counted and drawn without their texts; then the texts of the drawn
    ones, a bounded number, become feature lists, and one task fits the model to these.
    """
    known = usable_labels(labels, id_col, label_col)
    named = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"))
    known = checkpointed(known.join(named.distinct(), "id"))
    sizes = {r.good: r["count"] for r in known.groupBy("good").count().collect()}
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    # Twice what is wanted goes on to be ordered, whatever the number of labels is.
    bound = F.lit(0)
    for good, size in sizes.items():
        most = int(min(1.0, 2 * sample / size + 1e-6) * (1 << 30))
        bound = F.when(F.col("good") == good, F.lit(most)).otherwise(bound)
    by_hash = Window.partitionBy("good").orderBy(draw, "id")
    drawn = checkpointed(
        known.filter(draw <= bound)
        .withColumn("place", F.row_number().over(by_hash))
        .filter(F.col("place") <= sample)
        .select("id", "good", "place")
    )

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()).astype(np.int32) for t in batch.column(2)]
            lists = pa.array(found, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists], ["good", "place", "places"]
            )
        release_memory()

    texts = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .filter(F.col("text").isNotNull())
        # At most 2 * sample rows of an id, a flag and a number.
        .join(F.broadcast(drawn), "id")
        .groupBy("good", "place")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    )
    rows = checkpointed(texts.mapInArrow(listed, "good boolean, place int, places array<int>"))
    classes = (sizes.get(False, 0), sizes.get(True, 0))

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        frame = pd.concat(held).sort_values(["place", "good"])
        places = [np.asarray(p, np.int64) for p in frame["places"]]
        made = fit(places, frame["good"].to_numpy(bool), classes)
        yield pd.DataFrame(
            {
                "ratios": [made.ratios.tobytes()],
                "weights": [made.weights.tobytes()],
                "curve": [[made.bias, made.slope, made.offset]],
            }
        )
        release_memory()

    schema = "ratios binary, weights binary, curve array<double>"
    found = rows.repartition(1).mapInPandas(fitted, schema).collect()
    if not found:
        return fit([], np.zeros(0, bool), classes)
    ratios, weights = (np.frombuffer(found[0][c]) for c in ("ratios", "weights"))
    return Model(ratios, weights, *found[0]["curve"])


def scores(
    docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score"
) -> DataFrame:
    """`docs` with the score of each text; a null or empty text has that of the bias alone.

    Replaces a column of the score's name.
    """
    source = docs.drop(score_col)
    # Two arrays of a fixed number of places.
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = source.columns.index(text_col)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            found = [own.score(features(t.as_py())) for t in batch.column(at)]
            columns = [*batch.columns, pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, score_col])
        release_memory()

    return source.mapInArrow(score, extended(source, **{score_col: "double"}))


def held_out(id_col: Column) -> Column:
    """Documents that no model of the query is fitted to; a null id is none of them."""
    own = F.crc32(id_col.cast("string").cast("binary")) % 3 == 1
    return F.coalesce(own, F.lit(False))
