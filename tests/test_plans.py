"""What the executed plans must look like, whatever the scale."""

from __future__ import annotations

import re

import pytest

from oncolake.plans.joins import BROADCAST_SETTING
from workload import standins as s
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan_of(df):
    """The initial physical plan, without its adaptive wrapper."""
    return df._jdf.queryExecution().sparkPlan().toString()


def scans(plan, column):
    return len(re.findall(rf"FileScan parquet [^\n]*{column}#", plan))


def test_all_diseases_come_from_one_scan(spark):
    plan = plan_of(QUERIES["fold_change_all"](spark, SF))
    assert scans(plan, "l_partkey") == 1
    assert "Union" not in plan


def test_measures_are_not_shuffled_by_case(spark):
    plan = plan_of(QUERIES["fold_change_all"](spark, SF))
    assert re.search(r"BroadcastHashJoin \[case_id#\d+L\]", plan)
    assert re.search(r"BroadcastHashJoin \[gene_id#\d+L\].*LeftOuter", plan)
    assert "partial_avg" in plan


@pytest.mark.parametrize("name", ["fold_change_all", "expression_changed", "fold_change_ranked"])
def test_one_scan_also_where_nothing_is_broadcast(spark, name):
    settings = {BROADCAST_SETTING: "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        plan = plan_of(QUERIES[name](spark, SF))
        assert scans(plan, "l_partkey") == 1
        assert "BroadcastHashJoin" not in plan
    finally:
        for key in settings:
            spark.conf.unset(key)


@pytest.fixture
def nothing_broadcast(spark):
    settings = {BROADCAST_SETTING: "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


UNIQUE_KEYS = [
    "patient_update", "missing_files_anti", "expr_missing", "clinical_xml_extract", "expr_ingest",
]


@pytest.mark.parametrize("name", UNIQUE_KEYS)
def test_no_row_is_copied_for_a_key_that_cannot_be_hot(spark, nothing_broadcast, name):
    """The reports' list is exploded by the stand-in itself, below the join."""
    plan = plan_of(QUERIES[name](spark, SF))
    assert "_salt" not in plan and "spark_partition_id" not in plan
    assert plan.count("Generate") <= (name == "clinical_xml_extract")
    assert "BroadcastHashJoin" not in plan


def test_report_texts_do_not_move(spark, nothing_broadcast):
    df = QUERIES["clinical_xml_extract"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("ArrowEvalPython")]
    assert "Exchange hashpartitioning(filepath" in above
    below = re.findall(r"Exchange [^\n]*\n(?:[^\n]*\n){1,3}", above)
    assert below and not any("value" in part for part in below)
    assert "Exchange" not in plan[plan.index("ArrowEvalPython") : plan.index("c_mktsegment")]


def test_text_is_scanned_once(spark):
    plan = plan_of(QUERIES["expr_ingest"](spark, SF))
    assert scans(plan, "l_quantity") == 0
    assert len(re.findall(r"FileScan parquet [^\n]*staged-lines", plan)) == 2


def test_measures_by_case_stay_where_they_are(spark, nothing_broadcast, tmp_path):
    from oncolake.operators import cohort
    from oncolake.sources.tables import save_bucketed

    save_bucketed(
        s.expression(spark, SF), "by_case", str(tmp_path / "t"), "case_id", 6, "gene_id"
    )
    try:
        means = cohort.stage_means(spark.table("by_case"), s.patients(spark, SF), s.SPECS)
        plan = means._jdf.queryExecution().executedPlan().toString()
        join = plan[plan.index("SortMergeJoin") :]
        left = join[: join.index("FileScan parquet")]
        assert "Exchange" not in left
        assert "Bucketed: true" in join
        plain = cohort.stage_means(s.expression(spark, SF), s.patients(spark, SF), s.SPECS)
        assert sorted(map(tuple, means.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.sql("DROP TABLE by_case")


def test_jobs_of_building_a_report(spark):
    """Building runs the two jobs of one measurement, and no schema is looked up."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    try:
        QUERIES["fold_change_ranked"](spark, SF)
        assert len(tracker.getJobIdsForGroup("building")) <= 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_scan_reads_three_columns(spark):
    plan = plan_of(QUERIES["fold_change_all"](spark, SF))
    read = re.search(r"FileScan parquet \[([^\]]*l_partkey[^\]]*)\]", plan).group(1)
    assert len(read.split(",")) == 3
    assert "IsNotNull(l_quantity)" in plan


def test_patient_filters_are_pushed(spark):
    path = f"{SF}/customer.parquet"
    patients = spark.read.parquet(path).withColumnRenamed("c_mktsegment", "disease_type")
    from oncolake.operators.serving import select_patients

    plan = plan_of(select_patients(patients, "BUILDING"))
    assert "EqualTo(c_mktsegment,BUILDING)" in plan


def test_top_of_each_disease_limits_before_the_shuffle(spark):
    df = QUERIES["top_increased_all"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit [^\n]*Partial", plan)


def test_top_of_each_disease_reads_the_measures_once(spark):
    df = QUERIES["top_increased_all"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")]
    assert "ReusedExchange" in final
    assert scans(final, "l_partkey") == 1


def test_top_of_one_disease_sorts_nothing_whole(spark):
    df = QUERIES["sample_limit"](spark, SF)
    assert "TakeOrderedAndProject" in plan_of(df)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_needs_a_cross_join_or_a_single_task(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # A single partition is for sorted limits and for results of one row only.
    if name != "genome_total":
        assert "Exchange SinglePartition" not in plan


def test_ranking_has_partitioned_windows_only(spark):
    for name in ("top_increased", "top_decreased", "top_increased_all", "top_decreased_all"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"windowspecdefinition\((?:fold_change|gene)", plan)


def test_stand_in_counts(spark):
    """Row counts of the stand-ins, by hand."""
    assert s.expression(spark, SF).count() == 5855
    assert s.genome(spark, "/root/testdata/sf0.01").filter("id % 10 = 0").count() == 370
