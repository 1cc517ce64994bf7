from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from oncolake.functions import text


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("value", "number"),
    [
        ("1.5", 1.5),
        (" 2 ", 2.0),
        ("+3.", 3.0),
        ("-.5", -0.5),
        ("1e3", 1000.0),
        ("1E-2", 0.01),
        ("1_000", 1000.0),
        ("inf", math.inf),
        ("-Infinity", -math.inf),
        ("1e999", math.inf),
    ],
)
def test_numbers(spark, value, number):
    assert one(spark, value, text.parse_double) == number
    assert one(spark, value, text.is_number_field) is True
    assert one(spark, f'"{value}"', text.is_number_field) is True
    assert one(spark, f'"{value}"', text.number_of_field) == number


@pytest.mark.parametrize("value", ["nan", "NaN", "+nan", "-nan"])
def test_nan_is_a_number(spark, value):
    assert math.isnan(one(spark, value, text.parse_double))


@pytest.mark.parametrize(
    "value", ["", " ", "abc", "1d", "1.5f", "1__0", "_1", "1_", "1_.5", "1 2", "0x1", "1e", "."]
)
def test_no_numbers(spark, value):
    assert one(spark, value, text.parse_double) is None
    assert one(spark, value, text.is_number_field) is False
    assert one(spark, f'"{value}"', text.is_number_field) is False


@pytest.mark.parametrize("value", ['1.5"', '"1.5', ' "1.5"', '""1.5""'])
def test_stray_quotes_are_no_numbers(spark, value):
    assert one(spark, value, text.is_number_field) is False


def as_python_reads_it(text):
    try:
        return repr(float(text))
    except ValueError:
        return None


def test_numbers_are_those_python_reads(spark):
    rng = random.Random(7)
    pieces = list("0123456789") * 2 + list("+-._eE ") + ["inf", "NaN", "infinity", "x", "d"]
    texts = sorted({"".join(rng.choices(pieces, k=rng.randint(1, 6))) for _ in range(20000)})
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    rows = df.select("x", text.parse_double(F.col("x")).alias("v")).collect()
    got = {r.x: None if r.v is None else repr(r.v) for r in rows}
    assert got == {t: as_python_reads_it(t) for t in texts}
    assert sum(v is not None for v in got.values()) > 1000


def test_long_lines_cost_little(spark):
    for value in ("1" * 200000 + "x", "1_" * 100000, " " * 200000 + "x"):
        assert one(spark, value, text.is_number_field) is False


def test_positive(spark):
    rows = [0.0, -0.0, -1.0, 1e-300, math.inf, -math.inf, math.nan, None]
    df = spark.createDataFrame([(v,) for v in rows], "v double")
    kept = df.filter(text.is_positive(F.col("v"))).collect()
    assert sorted(r.v for r in kept) == [1e-300, math.inf]


@pytest.mark.parametrize(
    ("value", "plain"),
    [
        ('"a"', "a"),
        ('"a""b"', 'a"b'),
        ("a", "a"),
        ('"', '"'),
        ('""', ""),
        ('"a', '"a'),
        (None, None),
    ],
)
def test_unquote(spark, value, plain):
    assert one(spark, value, text.unquote) == plain


def test_strip_version(spark):
    assert one(spark, "G1.2.3", text.strip_version) == "G1"
    assert one(spark, "G1", text.strip_version) == "G1"


def test_regex_extract(spark):
    def gene(column):
        return text.regex_extract(column, "gene=([a-z.0-9]+)")

    assert one(spark, "xx GENE=Ab.1", gene) == "Ab.1"
    assert one(spark, "none", gene) == ""


def test_regex_groups(spark):
    pair = r"([0-9]+)\.\.([0-9]+)"
    assert one(spark, "join(5..20,30..40)", lambda c: text.regex_extract_groups(c, pair, 2)) == [
        "5",
        "20",
    ]
    assert one(spark, "<1..>20", lambda c: text.regex_extract_groups(c, pair, 2)) == []


def test_labels(spark):
    df = spark.createDataFrame(
        [("n", "text [Source: s]"), ("n", "plain"), ("n", None), (None, "x")],
        "name string, info string",
    )
    labels = [r[0] for r in df.select(text.gene_label(F.col("name"), F.col("info"))).collect()]
    assert labels == ["n<br />text ", "n<br />plain", None, None]


def test_compact_name(spark):
    assert one(spark, "Other  Specify", text.compact_name) == "OtherSpecify"
