from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from oncolake import schemas
from oncolake.operators import catalog
from oncolake.sources import files, tables


def entry(name, data_format, *cases):
    return {
        "file_name": name,
        "data_format": data_format,
        "extra": 1,
        "cases": [{"case_id": c, "project": {"project_id": p}} for c, p in cases],
    }


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("catalog")
    entries = [
        entry("a.xml", "BCR XML", ("c1", "P")),
        entry("b.txt", "TXT", ("c1", "P")),
        entry("c.xlsx", "XLSX", ("c1", "P")),
        entry("d.vcf", "VCF", ("c2", "P"), ("c3", "Q")),
        entry("e.none", None, ("c2", "P")),
        entry('q"uote.txt', "TXT", ("c4", "Q")),
        entry("unlisted.txt", "TXT", ("c4", "Q")),
        {"file_name": "f.vcf", "data_format": "VCF"},
    ]
    (root / "meta.json").write_text(json.dumps(entries, indent=2))
    names = [e["file_name"] for e in entries if e["file_name"] != "unlisted.txt"]
    lines = ["md5\tid\tfilename\tsize"] + [f"m\tdir{i}\t{n}\t7" for i, n in enumerate(names)]
    lines.append("m\tdir9\tunknown.txt\t7")
    (root / "manifest.tsv").write_text("\n".join(lines) + "\n")
    return catalog.build_index(
        files.read_manifest(spark, str(root / "manifest.tsv")),
        files.read_metadata(spark, str(root / "meta.json")),
    ).cache()


def test_index(index):
    rows = {r.filename: (r.path, r.data_format, r.project_id, r.case_id) for r in index.collect()}
    assert rows == {
        "a.xml": ("dir0", "BCR XML", "P", "c1"),
        "b.txt": ("dir1", "TXT", "P", "c1"),
        "d.vcf": ("dir3", "VCF", "PQ", "c2c3"),
        'q"uote.txt': ("dir5", "TXT", "Q", "c4"),
        "f.vcf": ("dir6", "VCF", "", ""),
    }


def test_routes_part_the_index(index):
    routes = [catalog.route(index, t) for t in ("xml_list", "txt_list", "unknowns")]
    names = [sorted(r.filename for r in route.collect()) for route in routes]
    assert names == [["a.xml"], ["b.txt", 'q"uote.txt'], ["d.vcf", "f.vcf"]]
    with pytest.raises(ValueError):
        catalog.route(index, "other")


def test_routes_in_one_write(spark, index):
    path = tables.scratch_path(spark, "lists")
    tables.save_table(catalog.with_list_table(index), path, partition_by=["list_table"])
    stored = tables.load_table(spark, path)
    for name in ("xml_list", "txt_list", "unknowns"):
        want = sorted(map(tuple, catalog.route(index, name).collect()))
        got = stored.filter(F.col("list_table") == name).drop("list_table")
        assert sorted(map(tuple, got.collect())) == want


def test_patients(index):
    assert sorted(map(tuple, catalog.distinct_patients(index).collect())) == [
        ("", ""), ("c1", "P"), ("c2c3", "PQ"), ("c4", "Q"),
    ]
    new = catalog.new_patients(index)
    assert new.columns == ["case_id", "project_id", "disease_type", "disease_stage", "gender"]
    assert all(r.gender is None and r.disease_type is None for r in new.collect())


def test_repeated_cases(spark):
    patients = spark.createDataFrame(
        [("c1", "P"), ("c1", "Q"), ("c2", "P")], "case_id string, project_id string"
    )
    assert list(map(tuple, catalog.repeated_cases(patients).collect())) == [("c1", 2)]


def test_paths(spark, index):
    paths = catalog.file_paths(index)
    assert ("c1", "dir1/b.txt") in set(map(tuple, paths.collect()))
    schema = "case_id string, path string, filename string"
    unknown = spark.createDataFrame([("c", None, "f")], schema)
    assert catalog.file_paths(unknown).first().filepath is None


def test_expression_files(spark):
    paths = spark.createDataFrame(
        [("c", "d/a.FPKM-UQ.txt.gz"), ("c", "d/a.FPKM.txt.gz"), ("c", "d-UQ.txt/a")],
        "case_id string, filepath string",
    )
    got = [r.filepath for r in catalog.expression_files(paths).collect()]
    assert got == ["d/a.FPKM-UQ.txt.gz", "d-UQ.txt/a"]


def test_missing_files(spark):
    schema = "case_id string, filepath string"
    paths = spark.createDataFrame([("c", "a"), ("c", "b"), ("d", "b"), ("d", "c")], schema)
    present = spark.createDataFrame([("a",), ("a",), ("z",)], "filepath string")
    missing = catalog.missing_files(paths, present)
    assert sorted(map(tuple, missing.select("case_id", "filepath").collect())) == [
        ("c", "b"), ("d", "b"), ("d", "c"),
    ]


def test_each_case_of_a_file(spark):
    manifest = spark.createDataFrame([("p", "a"), ("q", "b"), ("r", "c")], "path string, filename string")
    rows = [
        ("a", "TXT", [("c1", ("P1",)), ("c2", ("P2",))]),
        ("b", "TXT", [("c3", None)]),
        ("c", "TXT", None),
    ]
    metadata = spark.createDataFrame(rows, schemas.METADATA)
    each = catalog.build_index(manifest, metadata, each_case=True).collect()
    assert sorted((r.filename, r.case_id, r.project_id) for r in each) == [
        ("a", "c1", "P1"), ("a", "c2", "P2"), ("b", "c3", ""), ("c", "", ""),
    ]
    glued = catalog.build_index(manifest, metadata).collect()
    assert sorted((r.filename, r.case_id, r.project_id) for r in glued) == [
        ("a", "c1c2", "P1P2"), ("b", "c3", ""), ("c", "", ""),
    ]


def test_manifests_of_different_layouts(spark, tmp_path):
    (tmp_path / "1.txt").write_text("id\tfilename\tmd5\nd1\ta\tx\n\nd2\t\"b\"\tx\n")
    (tmp_path / "2.txt").write_text("size\tfilename\tid\n7\tc\td3\n8\t\td4\n9\n")
    rows = files.read_manifest(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(
        [("d1", "a"), ("d2", '"b"'), ("d3", "c"), ("d4", None), (None, None)], key=repr
    )
    (tmp_path / "3.txt").write_text("name\tfilename\nd1\ta\n")
    with pytest.raises(Exception, match="no header in"):
        files.read_manifest(spark, str(tmp_path)).collect()


@pytest.mark.parametrize(
    ("under", "inside", "outside"),
    [
        ("left*", ["left1/a", "left/b/c"], ["right/left1/a", "lef/a"]),
        ("a?c/", ["abc/x"], ["ac/x", "a/c/x", "abc"]),
        ("[0-4]*", ["0ab/x", "4/x"], ["5/x", "a0/x"]),
        ("[^0]*/b", ["a/b/x"], ["0/b/x", "a/x"]),
        ("{a,b.c}x", ["ax/1", "b.cx/1"], ["cx/1", "bbcx/1"]),
        ("a,b", ["a,b/x"], ["a/x"]),
        ("", ["anything"], []),
    ],
)
def test_parts_of_a_list(spark, under, inside, outside):
    rows = [("c", p) for p in inside + outside]
    paths = spark.createDataFrame(rows, "case_id string, filepath string")
    got = [r.filepath for r in catalog.under_part(paths, under).collect()]
    assert sorted(got) == sorted(inside)
