"""Summaries that can be merged, and the test made of them."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oncolake import jobs
from oncolake.functions.statistics import log_beta_half, student_p, welch
from oncolake.operators import moments
from oncolake.operators.cohort import stage_means
from oncolake.plans.cohorts import CohortSpec, cohort_members, stages
from oncolake.sources.tables import load_table, save_table
from tests.test_jobs import CASES, archive, base  # noqa: F401

SPECS = (CohortSpec("D", stages("I"), stages("II")), CohortSpec("E", stages("I"), stages("I")))
PATIENTS = "case_id string, disease_type string, disease_stage string"
MEASURES = "case_id string, gene_id string, gene_expr double, batch string"


def tail(t, df):
    """Two-sided p-value by quadrature, apart from any beta function."""
    u = np.arange(-5.0, 5.0 + 1e-9, 1 / 128)
    y = np.exp(np.pi / 2 * np.sinh(u))
    w = y * np.cosh(u)

    def area(start):
        return math.fsum(w * np.exp(-(df + 1) / 2 * np.log1p((start + y) ** 2 / df)))

    return area(abs(t)) / area(0.0)


def test_p_value(spark):
    rng = random.Random(3)
    pairs = [(t, df) for df in (0.5, 1, 1.5, 2, 3.7, 10, 49.5, 300, 5e3, 1e5) for t in
             (1e-9, 0.01, 0.3, 1.0, 1.5, 1.9, 2.3, 4, 9, 40)]
    pairs += [(rng.uniform(-6, 6), 10 ** rng.uniform(0, 4)) for _ in range(100)]
    rows = spark.createDataFrame([(float(t), float(v)) for t, v in pairs], "t double, df double")
    for row in rows.withColumn("p", student_p(F.col("t"), F.col("df"))).collect():
        assert row.p == pytest.approx(tail(row.t, row.df), rel=1e-7, abs=1e-9), (row.t, row.df)


def test_known_p_values(spark):
    """One degree of freedom is Cauchy's distribution; two have a closed form."""
    rows = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (0.0, 5.0)], "t double, df double")
    got = [r[0] for r in rows.select(student_p(F.col("t"), F.col("df"))).collect()]
    assert got == pytest.approx([0.5, 1 - 2 / math.sqrt(6), 1.0], abs=1e-13)


def test_odd_p_values(spark):
    inf, nan = math.inf, math.nan
    values = [(inf, 3.0), (-inf, 3.0), (nan, 3.0), (1.0, nan), (1.0, 0.0), (1.0, inf), (None, 1.0)]
    rows = spark.createDataFrame(values, "t double, df double")
    got = [r[0] for r in rows.select(student_p(F.col("t"), F.col("df"))).collect()]
    assert got == [0.0, 0.0, None, None, None, None, None]


def test_log_beta(spark):
    at = [0.05, 0.25, 0.5, 1.0, 7.3, 1e3, 1e8]
    rows = spark.createDataFrame([(a,) for a in at], "a double")
    got = [r[0] for r in rows.select(log_beta_half(F.col("a"))).collect()]
    for a, value in zip(at, got, strict=True):
        if a < 1e5:
            want = math.lgamma(a) + math.lgamma(0.5) - math.lgamma(a + 0.5)
        else:
            want = 0.5 * math.log(math.pi / a) + 1 / (8 * a)
        assert value == pytest.approx(want, abs=1e-11)


def summary(values):
    mean = math.fsum(values) / len(values)
    return len(values), math.fsum(values), math.fsum((v - mean) ** 2 for v in values)


def test_welch(spark):
    a, b = [3.0, 4.0, 1.0, 2.1], [3.0, 4.9, 9.0, 7.0, 5.5]
    cases = [(a, b), (b, a), (a, [1.0]), ([2.0, 2.0], [3.0, 3.0]), (a, [5.0, 5.0])]
    rows = spark.createDataFrame(
        [summary(x) + summary(y) for x, y in cases],
        "n1 long, t1 double, s1 double, n2 long, t2 double, s2 double",
    )
    got = [r[0] for r in rows.select(welch(*(F.col(c) for c in rows.columns))).collect()]
    va, vb = np.var(a, ddof=1) / 4, np.var(b, ddof=1) / 5
    t = (np.mean(a) - np.mean(b)) / math.sqrt(va + vb)
    df = (va + vb) ** 2 / (va**2 / 3 + vb**2 / 4)
    assert tuple(got[0]) == pytest.approx((t, df, tail(t, df)), abs=1e-9)
    assert tuple(got[1]) == pytest.approx((-t, df, tail(t, df)), abs=1e-9)
    assert tuple(got[2]) == tuple(got[3]) == (None, None, None)
    assert got[4].df == pytest.approx(3.0)


@pytest.mark.parametrize("seed", range(2))
def test_merged_batches_equal_all_measures(spark, seed):
    rng = random.Random(seed)
    patients = [(f"c{k}", rng.choice("DEX"), rng.choice(["Stage I", "Stage II"])) for k in range(30)]
    measured = [
        (rng.choice(patients)[0], rng.choice(["g1", "g2", "g3", None]),
         rng.choice([None, 1e8 + rng.random()]), str(rng.randrange(5)))
        for _ in range(400)
    ]
    known = spark.createDataFrame(patients, PATIENTS)
    rows = spark.createDataFrame(measured, MEASURES)
    members = cohort_members(known, SPECS)
    merged = moments.merge(moments.moments(rows, members, ["batch"])).collect()
    whole = moments.moments(rows, members).collect()
    want = {(r.disease_type, r.gene_id): r for r in whole}
    assert len(merged) == len(want) > 3
    for r in merged:
        other = want[r.disease_type, r.gene_id]
        for arm in ("early", "late"):
            assert r[f"{arm}_n"] == other[f"{arm}_n"]
            for part in ("total", "spread"):
                # A mean of 1e8 is known to some 1e-8, and so is a distance from it.
                close = 1e-12 if part == "total" else 1e-6
                assert r[f"{arm}_{part}"] == pytest.approx(other[f"{arm}_{part}"], rel=close)
    # Spread of some 1e-1 about means of 1e8: a difference of squares would be noise.
    values = [v for c, g, v, _ in measured if g == "g1" and v is not None
              and ("D", "Stage II") == next(p[1:] for p in patients if p[0] == c)]
    if len(values) > 1:
        got = next(r for r in merged if (r.disease_type, r.gene_id) == ("D", "g1"))
        assert got.late_spread == pytest.approx(summary(values)[2], rel=1e-6)
    got = moments.means(moments.merge(moments.moments(rows, members, ["batch"]))).collect()
    plain = stage_means(rows.filter("gene_expr is not null"), known, SPECS).collect()
    assert sorted((r.disease_type, r.gene_id) for r in got) == sorted(
        (r.disease_type, r.gene_id) for r in plain
    )


def test_infinite_measures(spark):
    rows = spark.createDataFrame(
        [("a", "g", math.inf, "1"), ("b", "g", 1.0, "1"), ("b", "g", 3.0, "2")], MEASURES
    )
    known = spark.createDataFrame([("a", "D", "Stage I"), ("b", "D", "Stage II")], PATIENTS)
    merged = moments.merge(moments.moments(rows, cohort_members(known, SPECS), ["batch"]))
    (found,) = moments.difference(merged).collect()
    assert (found.early_avg_expr, found.late_avg_expr) == (math.inf, 2.0)
    assert found.p_value is None


def stored_batches(spark, tmp_path, rows, runs):
    save_table(
        spark.createDataFrame(rows, MEASURES), str(tmp_path / "m"), mode="overwrite",
        partition_by=["batch"],
    )
    measures = load_table(spark, str(tmp_path / "m"), schema=MEASURES)
    marks = spark.createDataFrame(runs, "batch string, run string")
    cases = measures.select("case_id", "batch").distinct().join(marks, "batch")
    cases = cases.select("case_id", "run", "batch").unionByName(marks, allowMissingColumns=True)
    return measures, cases


def test_only_changed_batches_are_summed_up(spark, tmp_path):
    rows = [("a", "g", 1.0, "1"), ("b", "g", 2.0, "1"), ("c", "g", 3.0, "2"), ("d", "g", 4.0, "2")]
    rows += [("x", "g", 9.0, "3")]
    known = [("a", "D", "Stage I"), ("b", "D", "Stage II"), ("c", "D", "Stage I"),
             ("d", "D", "Stage II"), ("x", "Z", "Stage I")]

    def update(rows, runs, known):
        measures, cases = stored_batches(spark, tmp_path, rows, runs)
        patients = spark.createDataFrame(known, PATIENTS)
        paths = (str(tmp_path / "sums"), str(tmp_path / "members"))
        found = moments.update(spark, measures, cases, patients, *paths, SPECS)
        merged = moments.merge(moments.load(spark, paths[0]))
        got = sorted(tuple(r) for r in moments.means(merged).collect())
        want = sorted(tuple(r) for r in stage_means(measures, patients, SPECS).collect())
        assert got == want
        return found

    runs = [("1", "r"), ("2", "r"), ("3", "r")]
    assert update(rows, runs, known) == ["1", "2", "3"]
    assert update(rows, runs, known) == []
    # A patient of batch 2 comes to the other arm.
    known[2] = ("c", "D", "Stage II")
    assert update(rows, runs, known) == ["2"]
    # All members of batch 1 leave, and its rows with them.
    known[:2] = [("a", "Z", "Stage I"), ("b", "Z", "Stage I")]
    assert update(rows, runs, known) == ["1"]
    # A batch is replaced, then a new one comes.
    rows[3] = ("d", "g", 40.0, "2")
    assert update(rows, [("1", "r"), ("2", "s"), ("3", "r")], known) == ["2"]
    rows.append(("d", "h", 5.0, "4"))
    runs = [("1", "r"), ("2", "s"), ("3", "r"), ("4", "r")]
    assert update(rows, runs, known) == ["4"]


def test_jobs_from_moments(spark, base, archive):
    """The reports are those of all measures; a second run reads none of them."""
    want = {
        name: sorted(map(tuple, load_table(spark, f"{base}/{name}").collect()), key=repr)
        for name in ("fold_change_ranked", "expression_changed")
    }
    jobs.run_moments(spark, base)
    jobs.run_reports(spark, base, from_moments=True)
    for name, rows in want.items():
        got = load_table(spark, f"{base}/{name}").collect()
        assert sorted(map(tuple, got), key=repr) == rows
    found = load_table(spark, f"{base}/expression_difference").collect()
    by_gene = {(r.disease_type, r.gene_id): r for r in found}
    assert (by_gene["Breast", "G1"].early_n, by_gene["Breast", "G1"].late_n) == (2, 1)
    assert by_gene["Breast", "G1"].p_value is None
    # The part on the left is run again: it alone is summed up anew.
    jobs.run_expression(spark, base, str(archive / "data"), "left*")
    jobs.run_moments(spark, base)
    jobs.run_reports(spark, base, from_moments=True)
    got = load_table(spark, f"{base}/fold_change_ranked").collect()
    assert sorted(map(tuple, got), key=repr) == want["fold_change_ranked"]


def test_cases_of_the_batches_are_found_once(spark, monkeypatch):
    """An update asks for its cases several times: they are a table, not a scan of all measures."""
    from workload import queries

    asked = []
    monkeypatch.setattr(queries.moments, "update", lambda *given: asked.append(given[2]))
    monkeypatch.setattr(queries.moments, "load", lambda *_: None)
    monkeypatch.setattr(queries.moments, "merge", lambda parts: parts)
    queries._merged(spark, "/root/testdata/sf0.001")
    assert len(asked) == 2
    for cases in asked:
        assert cases.count() > 0
        assert all("/cases/" in name for name in cases.inputFiles())
