"""Benchmark decontamination: windows of test words found in training texts, and taken out.

Everything is DataFrame expressions. Words are runs of 0-9, a-z and characters beyond ASCII, after
A-Z became a-z. A window is `width` consecutive words of an item, or all words of a shorter item.

1. The distinct words of the test windows are a hash set inside the scan. It measures each
   text's longest run of such words, and a text whose runs are all shorter than the shortest
   window can hold none. Only the others keep their text.
2. The windows of those texts meet the test windows in a join on the whole window, which is at
   the same time the check of the hit. The test side is broadcast below a measured size.
3. The hits of a text are merged to spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncolake.llm.shared import ascii_lower, written

WIDTH = 10
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before A-Z become a-z.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Test windows are broadcast up to this size of their text, and shuffled beyond.
BROADCAST_BYTES = 64 * 1024 * 1024
#: Distinct test words up to which the scan looks them up; beyond, every text is searched.
MAX_VOCABULARY = 50_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _windows(words: Column, width: Column) -> Column:
    """All windows of `width` words, joined by a space, which no word holds."""
    first = F.sequence(F.lit(1), F.size(words) - width + 1)
    return F.when(
        F.size(words) >= width,
        F.transform(first, lambda i: F.array_join(F.slice(words, i, width), " ")),
    )


def test_windows(
    items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WIDTH
) -> DataFrame:
    """Distinct (item, size, gram) of the items that have an id and at least one word."""
    words = items.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("words"))
    return (
        words.filter(F.col("item").isNotNull() & (F.size("words") > 0))
        .withColumn("size", F.least(F.size("words"), F.lit(width)))
        .select("item", "size", F.explode(_windows(F.col("words"), F.col("size"))).alias("gram"))
        .distinct()
    )


def _longest_run(words: Column, known: Column) -> Column:
    """Length of the longest run of known words; `known` tests the lambda's word."""
    zero = F.struct(F.lit(0).alias("run"), F.lit(0).alias("most"))

    def step(acc: Column, word: Column) -> Column:
        run = F.when(known(word), acc["run"] + 1).otherwise(0)
        return F.struct(run.alias("run"), F.greatest(run, acc["most"]).alias("most"))

    return F.aggregate(words, zero, step, lambda acc: acc["most"])


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options
) -> DataFrame:
    """Per row of `docs`: the id, n_words, n_hit (words inside any occurrence of a window),
    `items` (those with occurring windows, as sorted strings) and `spans` (first word and the one
    behind the last, from 0, not touching each other). Options are those of `_search`.

    A null text has no words. Items without id or words take no part, an item id counts once
    however often it is repeated, and repeated documents are searched each. Without test windows
    nothing is hit. Other columns are not carried on.
    """
    found = _search(docs, items, F.struct(F.col(id_col).alias("id")), **options)
    return found.select(F.col("carried.id").alias(id_col), "n_words", "n_hit", "items", "spans")


def _search(
    docs: DataFrame,
    items: DataFrame,
    carried: Column,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
) -> DataFrame:
    """`carried` of every row with what was found in its text.

    Rows get a number of their own before they are written, so that both later reads of the
    written table mean the same row by it.
    """
    grams = written(test_windows(items, item_col, item_text_col, width), "test-windows")
    facts = grams.agg(
        F.collect_set("size").alias("sizes"),
        F.sum(F.octet_length("gram") + 32).alias("bytes"),
    ).first()
    sizes = sorted(facts.sizes)
    known = _vocabulary(grams)
    words = F.coalesce(words_of(F.col(text_col)), _empty("string"))
    if not sizes:
        searched = F.lit(False)
    elif known is None:
        searched = F.size("words") >= sizes[0]
    else:
        searched = _longest_run(F.col("words"), lambda word: word.isin(known)) >= sizes[0]
    scanned = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            carried.alias("carried"),
            F.col(text_col).alias("text"),
            words.alias("words"),
        ).select(
            "row",
            "carried",
            F.size("words").cast("long").alias("n_words"),
            F.when(searched, F.col("text")).alias("text"),
        ),
        "scanned",
    )
    small = (facts.bytes or 0) <= BROADCAST_BYTES
    searched_rows = scanned.filter(F.col("text").isNotNull())
    placed = (
        searched_rows.select("row", words_of(F.col("text")).alias("words"))
        .select("row", "words", F.explode(F.lit(sizes).cast("array<int>")).alias("size"))
        .select(
            "row", "size", F.posexplode(_windows(F.col("words"), F.col("size"))).alias("at", "gram")
        )
    )
    stretch = F.struct(F.col("at").alias("start"), (F.col("at") + F.col("size")).alias("end"))
    hits = (
        placed.join(F.broadcast(grams) if small else grams, ["size", "gram"])
        .groupBy("row")
        .agg(
            F.sort_array(F.collect_set(stretch)).alias("found"),
            F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"),
        )
        .select("row", _merged(F.col("found")).alias("spans"), "items")
    )
    # Rows that were not searched have no hits, and need not meet them.
    none = scanned.filter(F.col("text").isNull()).select("carried", "n_words")
    found = searched_rows.join(hits, "row", "left").select("carried", "n_words", "spans", "items")
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.unionByName(none, allowMissingColumns=True).select(
        "carried",
        "n_words",
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", _empty("string")).alias("items"),
        F.coalesce("spans", _empty("struct<start:int,end:int>")).alias("spans"),
    )


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _vocabulary(grams: DataFrame) -> list[str] | None:
    """The distinct words of the windows; None if they are too many to list.

    They are those of `words_of`, as in the join: lower() would change a Greek capital sigma by
    what stands beside it, and so one word of a text and of a window to two.
    """
    words = grams.select(F.explode(F.split("gram", " ")).alias("word"))
    found = words.distinct().limit(MAX_VOCABULARY + 1).collect()
    return [r[0] for r in found] if len(found) <= MAX_VOCABULARY else None


def _merged(found: Column) -> Column:
    """Sorted stretches, those that overlap or touch made one."""
    none = _empty("struct<start:int,end:int>")

    def step(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end")
        )
        body = F.slice(acc, F.lit(1), F.size(acc) - 1)
        return F.when(
            (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= s["start"]),
            F.concat(body, F.array(joined)),
        ).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(found, none, step)


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of the spans and what stands between and behind them."""
    words = F.regexp_extract_all(text, F.lit(WORD_ANY_CASE), F.lit(0))
    between = F.split(text, WORD_ANY_CASE, -1)

    def piece(word: Column, i: Column) -> Column:
        inside = F.exists(spans, lambda s: (i >= s["start"]) & (i < s["end"]))
        return F.when(inside, F.lit("")).otherwise(F.concat(word, F.get(between, i + 1)))

    kept = F.array_join(F.transform(words, piece), "")
    return F.when(F.size(spans) > 0, F.concat(F.get(between, F.lit(0)), kept)).otherwise(text)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    remove: str = "documents",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """`docs` without the documents that hold a window, or without the spans of the windows."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"unknown removal: {remove}")
    found = _search(docs, items, F.struct(*docs.columns), text_col, **options)
    row = {c: F.col("carried")[c] for c in docs.columns}
    if remove == "documents":
        found = found.filter(F.col("n_hit") == 0)
    else:
        row[text_col] = without_spans(row[text_col], F.col("spans"))
    return found.select(*(value.alias(c) for c, value in row.items()))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of `contamination`, and the items as one hash."""
    return found.select(
        id_col,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
