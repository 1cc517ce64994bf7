"""All jobs, one after the other, over a small archive of files."""

from __future__ import annotations

import gzip
import json
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from oncolake import jobs, schemas
from oncolake.sources.tables import load_table
from tests.test_clinical import report
from tests.test_genome import gene, genbank

CASES = {
    "c1": ("Breast", "Stage I", "FEMALE", {"G1": 1.0, "G2": 8.0, "G3": 2.0}),
    "c2": ("Breast", "Stage IB", "FEMALE", {"G1": 3.0, "G2": 0.0, "G3": 2.0}),
    "c3": ("Breast", "Stage IIA", "FEMALE", {"G1": 9.0, "G2": 2.0, "G3": 2.0}),
    "c4": ("Stomach", "Stage IIIA", "MALE", {"G1": 1.0, "G2": 1.0}),
    "c5": ("Stomach", "Stage IIIB", "MALE", {"G1": 2.5, "G2": 4.0}),
    "c6": ("Trunk", "Stage I", "MALE", {"G1": 1.0}),
}


def clinical_xml(site, stage, gender):
    return report(
        f"<p><st:event><st:pathologic_stage>{stage}</st:pathologic_stage></st:event>"
        f"<si:tumor_tissue_site>{site}</si:tumor_tissue_site><g:gender>{gender}</g:gender></p>"
    )


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    root = tmp_path_factory.mktemp("archive")
    entries, manifest = [], ["id\tfilename\tmd5"]

    def add(case, folder, name, data_format, content):
        path = root / "data" / folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
        cases = [{"case_id": case, "project": {"project_id": f"P-{case}"}}]
        entries.append({"file_name": name, "data_format": data_format, "cases": cases})
        manifest.append(f"{folder}\t{name}\tx")

    for i, (case, (site, stage, gender, genes)) in enumerate(CASES.items()):
        xml = clinical_xml(site, stage, gender).encode()
        add(case, f"x{i}", f"{case}.xml", "BCR XML", xml)
        lines = "".join(f"{g}.{i}\t{v}\n" for g, v in genes.items()).encode()
        part = "left" if i % 2 else "right"
        add(case, f"{part}{i}", f"{case}.FPKM-UQ.txt.gz", "TXT", gzip.compress(lines))
    add("c1", "left9", "c1-bad.FPKM-UQ.txt.gz", "TXT", gzip.compress(b"G1.1\t99\nG2.1\tx\n"))
    add("c1", "right9", "c1.bam", "BAM", b"binary")
    (root / "meta.json").write_text(json.dumps(entries))
    (root / "manifest.txt").write_text("\n".join(manifest))
    (root / "genome").mkdir()
    flat = genbank(gene("1..2", "G1.5", "ONE", "one [S]"), gene("3..4", "G2.1", "TWO"))
    (root / "genome" / "S.1.chromosome.7.dat.gz").write_bytes(gzip.compress(flat.encode()))
    return root


@pytest.fixture(scope="module")
def base(spark, archive):
    base = str(archive / "out")
    data = str(archive / "data")
    jobs.run_catalog(spark, base, str(archive / "meta.json"), str(archive / "manifest.txt"))
    jobs.run_clinical(spark, base, data)
    for under in ("left*", "right*", "left*"):
        jobs.run_expression(spark, base, data, under)
    jobs.run_genome(spark, base, str(archive / "genome"))
    jobs.run_reports(spark, base)
    return base


def test_patients(spark, base):
    rows = load_table(spark, f"{base}/patient_info").collect()
    assert {r.case_id: (r.disease_type, r.disease_stage, r.gender) for r in rows} == {
        case: values[:3] for case, values in CASES.items()
    }
    assert load_table(spark, f"{base}/repeated_cases").isEmpty()
    summary = load_table(spark, f"{base}/project_summary")
    assert summary.count() == 6


def test_measures(spark, base):
    rows = load_table(spark, f"{base}/gene_expr_table").collect()
    assert sorted((r.case_id, r.gene_id, r.gene_expr) for r in rows) == sorted(
        (case, g, v) for case, values in CASES.items() for g, v in values[3].items() if v > 0
    )
    rejected = load_table(spark, f"{base}/rejected_files").collect()
    assert [(r.filepath, r.bad_lines) for r in rejected] == [("left9/c1-bad.FPKM-UQ.txt.gz", 1)]


def test_reports(spark, base):
    ranked = load_table(spark, f"{base}/fold_change_ranked").collect()
    assert sorted((r.disease_type, r.gene_id, r.gene_name, r.fold_change) for r in ranked) == [
        ("Breast", "G1", "ONE", 4.5),
        ("Breast", "G2", "TWO", 0.25),
        ("Breast", "G3", None, 1.0),
        ("Stomach", "G1", "ONE", 2.5),
        ("Stomach", "G2", "TWO", 4.0),
    ]
    changed = load_table(spark, f"{base}/expression_changed").collect()
    assert sorted((r.disease_type, r.gene_id) for r in changed) == [
        ("Breast", "G1"), ("Breast", "G2"), ("Stomach", "G2"),
    ]


def test_a_report_reads_one_partition(spark, base):
    one = load_table(spark, f"{base}/fold_change_ranked").filter(F.col("disease_type") == "Breast")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(disease_type" in plan
    assert one.count() == 3


def test_missing_report_stops(spark, base, archive, tmp_path):
    before = load_table(spark, f"{base}/patient_info").collect()
    with pytest.raises(FileNotFoundError, match="x0/c1.xml"):
        jobs.run_clinical(spark, base, str(tmp_path))
    assert load_table(spark, f"{base}/patient_info").collect() == before


def test_missing_expression_file_stops_or_is_recorded(spark, archive, tmp_path):
    other, data = str(tmp_path / "out"), tmp_path / "data"
    shutil.copytree(archive / "data", data)
    gone = "left1/c2.FPKM-UQ.txt.gz"
    (data / gone).unlink()
    jobs.run_catalog(spark, other, str(archive / "meta.json"), str(archive / "manifest.txt"))
    with pytest.raises(FileNotFoundError, match=gone):
        jobs.run_expression(spark, other, str(data), "left*")
    assert not Path(other, "gene_expr_table").exists()
    # The file belongs to another part.
    jobs.run_expression(spark, other, str(data), "right*")
    jobs.run_expression(spark, other, f"{data}/../data/", "left*", "record")
    recorded = load_table(spark, f"{other}/missing_files").collect()
    assert [(r.filepath, r.case_id, r.batch) for r in recorded] == [(gone, "c2", "left*")]
    rows = load_table(spark, f"{other}/gene_expr_table").collect()
    assert {r.case_id for r in rows} == set(CASES) - {"c2"}
    with pytest.raises(ValueError):
        jobs.run_expression(spark, other, str(data), on_missing="ignore")


def test_clinical_in_parts(spark, base, archive, tmp_path):
    """Two parts that do not overlap, one of them twice, give what one run gives."""
    other, data = str(tmp_path / "out"), str(archive / "data")
    jobs.run_catalog(spark, other, str(archive / "meta.json"), str(archive / "manifest.txt"))
    for under in ("x[0-2]", "x[3-5]", "x[0-2]"):
        jobs.run_clinical(spark, other, data, under=under)
    for table in ("patient_info", "project_summary"):
        parts, whole = (load_table(spark, f"{b}/{table}").collect() for b in (other, base))
        assert sorted(map(tuple, parts), key=repr) == sorted(map(tuple, whole), key=repr)
    assert load_table(spark, f"{other}/clinical").count() == len(CASES)


def test_measures_by_case(spark, base, archive):
    """The bucketed layout gives the same reports, and a later session can read it."""
    want = load_table(spark, f"{base}/fold_change_ranked").collect()
    jobs.run_layout(spark, base, 4)
    spark.sql("DROP TABLE gene_expr_by_case")
    for _ in range(2):
        jobs.run_reports(spark, base, buckets=4)
        got = load_table(spark, f"{base}/fold_change_ranked").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    spark.sql("DROP TABLE gene_expr_by_case")


def test_glued_cases_reach_reports_one_by_one(spark, tmp_path):
    base, data = str(tmp_path / "out"), tmp_path / "data"
    cases = [{"case_id": c, "project": {"project_id": "P"}} for c in ("c1", "c2")]
    entry = {"file_name": "a.FPKM-UQ.txt", "data_format": "TXT", "cases": cases}
    (tmp_path / "meta.json").write_text(json.dumps([entry]))
    (tmp_path / "manifest.txt").write_text("id\tfilename\nd\ta.FPKM-UQ.txt\n")
    (data / "d").mkdir(parents=True)
    (data / "d" / "a.FPKM-UQ.txt").write_text("G1.1\t2\n")
    for each_case, want in ((False, ["c1c2"]), (True, ["c1", "c2"])):
        jobs.run_catalog(
            spark, base, str(tmp_path / "meta.json"), str(tmp_path / "manifest.txt"),
            each_case=each_case,
        )
        jobs.run_expression(spark, base, str(data))
        rows = load_table(spark, f"{base}/gene_expr_table").collect()
        assert sorted(r.case_id for r in rows) == want


def test_quarantine(spark, archive, tmp_path):
    other = str(tmp_path / "out")
    data = tmp_path / "data"
    for i, (case, values) in enumerate(CASES.items()):
        (data / f"x{i}").mkdir(parents=True)
        text = "<broken" if case == "c2" else clinical_xml(*values[:3])
        if case != "c3":
            (data / f"x{i}" / f"{case}.xml").write_text(text)
    jobs.run_catalog(spark, other, str(archive / "meta.json"), str(archive / "manifest.txt"))
    jobs.run_clinical(spark, other, str(data), "quarantine")
    rows = {r.case_id: r.disease_type for r in load_table(spark, f"{other}/patient_info").collect()}
    assert rows == {
        "c1": "Breast", "c2": None, "c3": None, "c4": "Stomach", "c5": "Stomach", "c6": "Trunk",
    }
    malformed = load_table(spark, f"{other}/malformed_reports").collect()
    assert [r.case_id for r in malformed] == ["c2"]
    missing = load_table(spark, f"{other}/missing_reports").collect()
    assert [r.case_id for r in missing] == ["c3"]


def test_nothing_at_all(spark, tmp_path):
    """Jobs over empty inputs leave empty tables that can be read."""
    base = str(tmp_path / "out")
    (tmp_path / "meta.json").write_text("[]")
    (tmp_path / "manifest.txt").write_text("id\tfilename\n")
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "S.1.chromosome.7.dat.gz").write_bytes(gzip.compress(b"LOCUS\n"))
    (tmp_path / "data" / "a.FPKM-UQ.txt").write_bytes(b"G1.1\t1\n")
    data = str(tmp_path / "data")
    jobs.run_catalog(spark, base, str(tmp_path / "meta.json"), str(tmp_path / "manifest.txt"))
    jobs.run_clinical(spark, base, data)
    jobs.run_expression(spark, base, data)
    jobs.run_genome(spark, base, data)
    jobs.run_reports(spark, base)
    for table in ("patient_info", "project_summary", "gene_expr_table", "hs_genome"):
        assert load_table(spark, f"{base}/{table}").isEmpty()
    ranked = load_table(
        spark, f"{base}/fold_change_ranked", schema=schemas.FOLD_CHANGE_RANKED
    )
    assert ranked.isEmpty()


def test_arguments(monkeypatch):
    seen = {}

    def record(session, **options):
        seen.update(options, session=session)

    record.__name__ = "record"
    monkeypatch.setattr(jobs, "build_session", lambda name: "session")
    monkeypatch.setattr(jobs, "run_expression", record)
    jobs.main(["expression", "/b", "--root", "/r", "--under", "0*"])
    assert seen == {
        "session": "session", "base": "/b", "root": "/r", "under": "0*", "check_gzip": False,
        "on_missing": "fail", "by_content": False,
    }
