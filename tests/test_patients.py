"""Patients that come in batches, and the slices of their table."""

from __future__ import annotations

import json
from pathlib import Path

import pytest

from oncolake import jobs, schemas
from oncolake.operators import patients
from oncolake.sources.tables import load_table
from tests.test_jobs import CASES, archive, clinical_xml  # noqa: F401

STORED = f"{schemas.PATIENT_INFO}, slice int"


def rows_of(spark, pairs):
    rows = [(c, p, None, None, None) for c, p in pairs]
    return spark.createDataFrame(rows, schemas.PATIENT_INFO)


def append(spark, path, pairs, slices=8):
    rows = rows_of(spark, pairs)
    named = patients.named_slices(rows, slices)
    patients.append_patients(rows, path, named, slices=slices)
    return named


def stored(spark, path):
    rows = load_table(spark, path, schema=STORED).collect()
    return sorted(((r.case_id, r.project_id) for r in rows), key=repr)


def test_only_unseen_patients_are_added(spark, tmp_path):
    path = str(tmp_path / "p")
    first = [(f"c{k}", "P") for k in range(20)] + [(None, "P"), ("c1", None)]
    second = [(f"c{k}", "P") for k in range(10, 30)] + [(None, "P"), ("c1", None), ("c2", "Q")]
    append(spark, path, first)
    files = sorted(Path(path).rglob("*.parquet"))
    append(spark, path, first)
    assert sorted(Path(path).rglob("*.parquet")) == files
    for _ in range(2):
        append(spark, path, second)
        assert stored(spark, path) == sorted({*first, *second}, key=repr)


def test_nothing_to_append(spark, tmp_path):
    path = str(tmp_path / "p")
    assert append(spark, path, []) == []
    assert stored(spark, path) == []
    assert load_table(spark, path).columns == [f.split()[0] for f in schemas.PATIENT_INFO.split(", ")]


def record(case, path, stage="Stage I"):
    return (case, path, stage, "Breast", "FEMALE")


def clinical(spark, rows):
    return spark.createDataFrame(rows, schemas.CLINICAL)


@pytest.fixture
def table(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("listed", "records", "target")]
    cases = [(f"c{k}", "P") for k in range(40)]
    rows = rows_of(spark, cases)
    named = patients.named_slices(rows)
    patients.append_patients(rows, paths[0], named)
    patients.refresh(spark, *paths, named)
    return paths


def found(spark, paths):
    rows = load_table(spark, paths[2], schema=STORED).collect()
    return {r.case_id: r.disease_stage for r in rows}


def save(spark, paths, batch, rows):
    named = patients.save_records(clinical(spark, rows), paths[1], batch)
    patients.refresh(spark, *paths, named)
    return named


def test_batches_update_in_any_order(spark, table):
    """The largest path wins over all batches; a batch that is run again is replaced."""
    save(spark, table, "b", [record("c1", "z", "late"), record("c2", "a")])
    save(spark, table, "a", [record("c1", "y", "early"), record("c2", "b", None)])
    got = found(spark, table)
    assert len(got) == 40
    assert (got["c1"], got["c2"], got["c3"]) == ("late", None, None)
    named = save(spark, table, "b", [record("c5", "q", "five")])
    assert len(named) <= 3
    got = found(spark, table)
    assert (got["c1"], got["c2"], got["c5"]) == ("early", None, "five")
    save(spark, table, "b", [])
    assert found(spark, table)["c5"] is None


def test_other_slices_are_not_touched(spark, table):
    """Their files cannot be read at all here, and stay as they are."""
    number = patients.named_slices(rows_of(spark, [("c7", "P")]))[0]
    save(spark, table, "old", [record(f"c{k}", "a") for k in range(40)])
    broken = {}
    for path in table:
        for file in Path(path).rglob("slice=*/*.parquet"):
            if file.parent.name != f"slice={number}":
                file.write_bytes(b"no table")
                (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
                broken[file] = file.stat().st_mtime_ns
    assert broken
    assert save(spark, table, "new", [record("c7", "b", "new")]) == [number]
    assert all(file.stat().st_mtime_ns == at for file, at in broken.items())
    own = load_table(spark, table[2], schema=STORED).filter(f"slice = {number}")
    assert {r.case_id: r.disease_stage for r in own.collect()}["c7"] == "new"


def test_refresh_prunes_in_the_plan(spark, table):
    save(spark, table, "a", [record("c1", "a")])
    rows = patients.refreshed(spark, *table[:2], [3, 5])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [slice") + plan.count("PartitionFilters: [isnotnull") == 2
    assert "slice#" in plan and "IN (3,5)" in plan


def catalog_batch(tmp_path, name, entries):
    meta = [
        {"file_name": f, "data_format": "BCR XML",
         "cases": [{"case_id": c, "project": {"project_id": p}}]}
        for f, c, p in entries
    ]
    (tmp_path / f"{name}.json").write_text(json.dumps(meta))
    lines = ["id\tfilename", *(f"d\t{f}" for f, _, _ in entries)]
    (tmp_path / f"{name}.txt").write_text("\n".join(lines))
    return str(tmp_path / f"{name}.json"), str(tmp_path / f"{name}.txt")


def test_jobs_in_batches(spark, tmp_path):
    """Two catalog batches with the clinical job before, between and after; as one run over all."""
    data = tmp_path / "data" / "d"
    data.mkdir(parents=True)
    for k in range(4):
        (data / f"r{k}.xml").write_text(clinical_xml("Breast", f"Stage {k}", "FEMALE"))
    first = [(f"r{k}.xml", f"c{k}", "P") for k in range(3)]
    second = [("r3.xml", "c3", "P"), ("r2.xml", "c2", "P"), ("r1.xml", "c1", "Q")]
    one, two, whole = str(tmp_path / "one"), str(tmp_path / "two"), str(tmp_path / "whole")
    batches = {"a": catalog_batch(tmp_path, "a", first), "b": catalog_batch(tmp_path, "b", second)}
    everything = catalog_batch(tmp_path, "all", first + second)
    root = str(tmp_path / "data")
    jobs.run_catalog(spark, whole, *everything)
    jobs.run_clinical(spark, whole, root)
    for base, order in ((one, "aCbCa"), (two, "abbC")):
        for step in order:
            if step == "C":
                jobs.run_clinical(spark, base, root)
            else:
                jobs.run_catalog(spark, base, *batches[step], batch=step)
        for name in ("patient_info", "project_summary", "repeated_cases"):
            got, want = (load_table(spark, f"{b}/{name}").collect() for b in (base, whole))
            assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr), name
    assert [r.case_id for r in load_table(spark, f"{one}/repeated_cases").collect()] == ["c1"]
