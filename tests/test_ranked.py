"""Ranked reports stored in order, and their ends read from the files there."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from oncolake import schemas
from oncolake.operators import cohort
from oncolake.operators.reports import save_ranked, stored_top
from oncolake.sources.tables import load_table

RATIOS = [None, float("nan"), float("inf"), 2.0, 1.0, 0.5, 0.0, -0.0]
DISEASES = ["A", "B", "with / and = é%"]


@pytest.fixture(scope="module")
def rows(spark):
    """Every ratio with every label, nulls among them, and more of the first disease."""
    labels = itertools.product(RATIOS, ["g1", "g2", None], ["n", None], ["7", None], [None, "i"])
    some = [(g, n, r, c, i) for r, g, n, c, i in labels]
    data = [(d, *row) for d in DISEASES for row in some[: 40 if d == "B" else None]]
    data += [("A", f"g{k}", "n", 1 + k / 500, "X", "i") for k in range(700)]
    return spark.createDataFrame(data, schemas.FOLD_CHANGE_RANKED).repartition(5).cache()


@pytest.fixture(scope="module")
def base(rows, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("ranked") / "é +%41")
    save_ranked(rows, base, rows_per_file=60)
    return base


def keyed(rows):
    return [tuple(map(str, r)) for r in rows]


def test_all_rows_are_stored(spark, rows, base):
    stored = load_table(spark, f"{base}/fold_change_ranked", schema=schemas.FOLD_CHANGE_RANKED)
    stored = stored.select(rows.columns)
    assert sorted(keyed(stored.collect())) == sorted(keyed(rows.collect()))


def test_files_are_stretches_of_the_ranking(spark, rows, base):
    files = load_table(spark, f"{base}/fold_change_files")
    assert files.agg(F.max("rows")).first()[0] <= 60
    stored = load_table(spark, f"{base}/fold_change_ranked", schema=schemas.FOLD_CHANGE_RANKED)
    stored = stored.withColumn("file", F.col("_metadata.file_name"))
    for disease in DISEASES:
        ranked = cohort.ranked(stored.filter(F.col("disease_type") == disease)).collect()
        order = [name for name, _ in itertools.groupby(r.file for r in ranked)]
        assert len(order) == len(set(order)) > (1 if disease != "B" else 0)


def test_place_key_is_the_ranking(rows):
    down = [tuple(map(str, r)) for r in cohort.ranked(rows.distinct()).collect()]
    by_key = [tuple(map(str, r)) for r in rows.distinct().orderBy(cohort.place_key()).collect()]
    # Zeros of both signs are equal, and diseases are not part of the ranking.
    strip = lambda all_: [tuple(r[1:]) for r in all_]
    flat = lambda all_: [tuple(x.replace("-0.0", "0.0") for x in r) for r in strip(all_)]
    assert flat(down) == flat(by_key)


@pytest.mark.parametrize("disease", DISEASES)
@pytest.mark.parametrize("increased", [True, False])
@pytest.mark.parametrize("n", [1, 10, 150, 5000])
def test_either_end(spark, rows, base, disease, increased, n):
    want = cohort.top_of_one(rows.filter(F.col("disease_type") == disease), n, increased)
    got = stored_top(spark, base, disease, n, increased)
    plain = lambda rs: [tuple(str(x).replace("-0.0", "0.0") for x in r) for r in rs]
    assert plain(got.collect()) == plain(want.collect())


def test_one_file_is_opened(spark, base):
    assert len(stored_top(spark, base, "A").inputFiles()) == 1
    assert len(stored_top(spark, base, "A", increased=False).inputFiles()) <= 2
    files = load_table(spark, f"{base}/fold_change_files").filter("disease_type = 'A'")
    assert files.count() > 10


def test_nothing_stored(spark, rows, base, tmp_path):
    none = stored_top(spark, base, "C")
    assert none.schema == rows.schema and none.collect() == []
    save_ranked(rows.limit(0), str(tmp_path))
    assert stored_top(spark, str(tmp_path), "A").collect() == []
