"""Secret scan: fixed patterns, and character Markov models of random strings and identifiers.

Everything is DataFrame expressions. Two first-order models, one of random strings and one of
ordinary identifiers, give every pair of neighbouring characters a log-likelihood ratio; the two
are trained by counting the pairs of labelled samples. A long token whose pairs look random on
average is a span of kind `markov`, unless it lies inside a span of the fixed patterns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.llm.spans import located

# The base patterns and the least length of what they find.
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 12
# A run of fewer characters is dropped, and no longer match can start inside of one.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")

#: Tokens that the models judge, and the mean log-likelihood ratio of a pair from which on a
#: token counts as random.
TOKEN = r"[A-Za-z0-9+/_-]{16,}"
THRESHOLD = 0.5
#: Bounds of the labelled sample: strings of each class, and documents that they come from.
SAMPLE_STRINGS = 20_000
SAMPLE_DOCS = 4_000
#: Characters of a token are numbered by their code, below 128.
CODES = 128

_SPAN = "array<struct<start:int,end:int,found:string>>"


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each fixed pattern, those too short dropped."""
    assign = F.filter(
        located(text, ASSIGN),
        lambda s: F.length(F.regexp_extract(s["found"], ASSIGN, 1)) >= ASSIGN_LEAST,
    )
    return {"assign": assign, "access": located(text, ACCESS), "hex": located(text, HEX)}


def _suspect(text: Column) -> Column:
    """Whether a text can hold any span at all."""
    return text.rlike(rf"{ASSIGN}|{ACCESS}|{HEX}|{TOKEN}")


def random_strings(spark: SparkSession, n: int = SAMPLE_STRINGS) -> DataFrame:
    """Strings in the alphabets that keys come in, made from hashes of numbers."""
    hashed = F.sha2(F.col("id").cast("string"), 256)
    coded = F.base64(F.unhex(hashed))
    forms = F.array(
        F.substring(hashed, 1, 40),
        F.substring(F.regexp_replace(coded, "=", ""), 1, 40),
        F.substring(F.upper(F.regexp_replace(coded, "[^A-Za-z0-9]", "")), 1, 24),
    )
    return spark.range(max(1, n // 3)).select(F.explode(forms).alias("string"))


def labelled_sample(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    strings: int = SAMPLE_STRINGS,
    from_docs: int = SAMPLE_DOCS,
) -> DataFrame:
    """(string, random): ordinary words of documents chosen by the hash of their id, and random
    strings. What the fixed patterns find in those documents is random, too.
    """
    share = max(1, docs.count() // max(1, from_docs))
    chosen = docs.filter(
        (F.pmod(F.xxhash64(F.col(id_col)), F.lit(share)) == 0) & F.col(text_col).isNotNull()
    ).select(F.col(text_col).alias("text"))
    clean = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX):
        clean = F.regexp_replace(clean, pattern, " ")
    words = F.regexp_extract_all(clean, F.lit(r"[A-Za-z0-9+/_-]{6,}"), F.lit(0))
    secrets = F.concat(
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(1)),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )

    def bounded(column: Column, random: bool) -> DataFrame:
        found = chosen.select(F.explode(column).alias("string")).distinct()
        ordered = found.orderBy(F.xxhash64("string"), "string").limit(strings)
        return ordered.select("string", F.lit(random).alias("random"))

    made = random_strings(docs.sparkSession, strings).select("string", F.lit(True).alias("random"))
    return bounded(words, False).unionByName(bounded(secrets, True)).unionByName(made)


def _pairs(string: Column) -> Column:
    """Numbers of the neighbouring pairs of characters."""
    code = F.transform(F.split(string, ""), lambda c: F.ascii(c))
    return F.transform(
        F.sequence(F.lit(0), F.length(string) - 2),
        lambda i: F.get(code, i) * CODES + F.get(code, i + 1),
    )


def train(sample: DataFrame) -> list[float]:
    """Log-likelihood ratio, random against ordinary, of every pair of characters.

    Counts get one added for each pair of token characters. The result has CODES x CODES entries,
    whatever the sample's size; pairs with other characters have 0.
    """
    counts = (
        sample.filter(F.length("string") >= 2)
        .filter(~F.col("string").rlike(r"[^\x00-\x7F]"))
        .select("random", F.explode(_pairs(F.col("string"))).alias("pair"))
        .groupBy("random", "pair")
        .count()
        .collect()
    )
    letters = [c for c in range(CODES) if chr(c).isalnum() or chr(c) in "+/_-"]
    seen = {(r.random, r.pair): r["count"] for r in counts}
    table = [0.0] * (CODES * CODES)
    logs: dict[bool, dict[int, float]] = {}
    for kind in (True, False):
        logs[kind] = {}
        for a in letters:
            row = {a * CODES + b: seen.get((kind, a * CODES + b), 0) + 1 for b in letters}
            total = sum(row.values())
            logs[kind].update({pair: math.log(n / total) for pair, n in row.items()})
    for pair, value in logs[True].items():
        table[pair] = value - logs[False][pair]
    return table


def _mean_ratio(token: Column, table: Column) -> Column:
    total = F.aggregate(_pairs(token), F.lit(0.0), lambda sum_, pair: sum_ + F.get(table, pair))
    return total / (F.length(token) - 1)


def scan(
    docs: DataFrame,
    ratios: list[float],
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row of `docs`: the id and `spans`, array of (start, end, kind, found) by start, then
    kind as in KINDS. Places are code points, the end exclusive. Spans may overlap: a random token
    is left out only if one span of a fixed pattern holds all of it.

    A null or empty text has no spans; repeated rows are scanned each; other columns are not
    carried on. Nothing is shuffled.
    """
    # The table is one foldable string, not thousands of literals.
    table = F.split(F.lit(",".join(f"{r:.6f}" for r in ratios)), ",").cast("array<double>")
    text = F.col("text")
    base = base_spans(text)
    marked = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).select("id", "text", _suspect(text).alias("suspect"))

    def when_suspect(spans: Column) -> Column:
        return F.when(F.col("suspect"), spans).otherwise(F.array().cast(_SPAN))

    placed = marked.select(
        "id",
        *(when_suspect(spans).alias(kind) for kind, spans in base.items()),
        when_suspect(
            F.filter(located(text, TOKEN), lambda s: _mean_ratio(s["found"], table) >= threshold)
        ).alias("markov"),
    )

    def tagged(kind: str) -> Column:
        return F.transform(
            kind,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.lit(KINDS.index(kind)).alias("order"),
                s["end"].alias("end"),
                F.lit(kind).alias("kind"),
                s["found"].alias("found"),
            ),
        )

    fixed = F.concat(*(tagged(k) for k in KINDS[:-1]))
    return placed.select("id", fixed.alias("fixed"), tagged("markov").alias("markov")).select(
        F.col("id").alias(id_col),
        F.array_sort(
            F.concat(
                "fixed",
                F.filter(
                    "markov",
                    lambda m: ~F.exists(
                        "fixed", lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"])
                    ),
                ),
            )
        ).alias("spans"),
    )


def _listed(spans: Column) -> Column:
    def text(s: Column) -> Column:
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    return F.array_join(F.transform(spans, text), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the fixed kinds, their spans as one hash, and all spans as text."""
    spans = F.col("spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"] != "markov")
    return found.select(
        id_col,
        *(count(k) for k in KINDS[:-1]),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
    )
