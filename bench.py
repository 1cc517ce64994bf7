"""Headline queries at one scale: prints one JSON line with the median time of each."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oncolake.operators.cohort import fold_change_ranked  # noqa: E402
from oncolake.session import build_session  # noqa: E402
from workload import standins  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "fold_change_ranked",
    "expression_changed",
    "fold_change_all",
    "top_increased",
    "top_increased_all",
    "cohort_mean",
    "project_summary",
    "stage_eligibility",
    "catalog_join",
    "patients_distinct",
    "expr_ingest",
    "clinical_xml_extract",
    "patient_update",
    "genome_reference",
]


def one_by_one(spark, sf_dir):
    """Every disease as a report of its own, to compare with `fold_change_all`."""
    return [
        fold_change_ranked(
            standins.expression(spark, sf_dir),
            standins.patients(spark, sf_dir),
            standins.genome(spark, sf_dir),
            spec,
        )
        for spec in standins.SPECS
        if not spec.is_placeholder
    ]


def seconds(run) -> float:
    """From building the query to its last row."""
    start = time.perf_counter()
    result = run()
    for df in result if isinstance(result, list) else [result]:
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            # One process: a temporary folder is shared by all there is.
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="oncolake-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = {name: (lambda q=QUERIES[name]: q(spark, SF_DIR)) for name in HEADLINE}
    runs["fold_change_one_by_one"] = lambda: one_by_one(spark, SF_DIR)
    timings = {}
    for name, run in runs.items():
        seconds(run)
        timings[name] = round(statistics.median(seconds(run) for _ in range(RUNS)), 3)
    total = round(sum(t for name, t in timings.items() if name in HEADLINE), 3)
    line = {
        "metric": "headline_total",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
