"""Files known by their contents, and lines that are unpacked whatever a file is called."""

from __future__ import annotations

import gzip
import random

import pyarrow as pa
import pytest

from oncolake import jobs, schemas
from oncolake.sources import contents, files
from oncolake.sources.tables import load_table

LINES = b"G1.1\t1\r\n\nG2.1\t2\rG3.1\t\xff\n\xc3\xa9"
FILES = {
    "right.txt.gz": gzip.compress(LINES),
    "right.TXT.GZ": gzip.compress(LINES),
    "right.txt": LINES,
    "wrong.txt": gzip.compress(LINES),
    "sub dir/wrong+plain%20 é.gz": LINES,
    "members.dat": gzip.compress(b"a\r") + gzip.compress(b"\nb\n"),
    "empty.gz": b"",
    "empty.txt": b"",
    "one.txt": b"\x1f",
    "nothing.gz": gzip.compress(b""),
}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("names that lie")
    for name, content in FILES.items():
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).write_bytes(content)
    return str(root)


def test_files_are_known_by_two_bytes(spark, root):
    found = {r.filepath: r for r in contents.packed_files(spark, root).collect()}
    some = {name: content for name, content in FILES.items() if content}
    assert set(found) == set(some)
    for name, content in some.items():
        row = found[name]
        assert row.gzip == (content[:2] == b"\x1f\x8b")
        assert row.named_gzip == name.lower().endswith(".gz")
        assert row.length == len(content)
    wrong = {"wrong.txt", "sub dir/wrong+plain%20 é.gz", "members.dat"}
    assert {r.filepath for r in contents.misnamed_files(spark, root).collect()} == wrong
    packed = {n for n, c in FILES.items() if c[:2] == b"\x1f\x8b"}
    got = contents.gzip_files(spark, root)
    assert got.columns == ["filepath", "length", "modified"]
    assert {r.filepath for r in got.collect()} == packed
    under = contents.packed_files(spark, root, "*.gz", "sub dir").collect()
    assert [r.filepath for r in under] == ["sub dir/wrong+plain%20 é.gz"]


def test_contents_are_not_read(spark, root):
    plan = contents.packed_files(spark, root)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "content" not in scan


def of_file(rows):
    out = {}
    for name, value in rows:
        out.setdefault(name, []).append(bytes(value))
    return {name: sorted(values) for name, values in out.items()}


def lines_of(df):
    return of_file((r.filepath, r.v) for r in df.selectExpr("filepath", "cast(value as binary) v").collect())


def test_lines_are_those_of_the_plain_reader(spark, root):
    got = lines_of(contents.read_lines(spark, root))
    by_name = lines_of(files.read_lines(spark, root, "right.txt*"))
    assert by_name["right.txt"] == by_name["right.txt.gz"]
    for name in ("right.txt", "right.txt.gz", "right.TXT.GZ", "wrong.txt", "sub dir/wrong+plain%20 é.gz"):
        assert got.pop(name) == by_name["right.txt"]
    assert got == {"members.dat": [b"a", b"b"], "one.txt": [b"\x1f"]}


@pytest.mark.parametrize("piece", [1, 2, 3, 7])
def test_ends_of_lines_at_ends_of_pieces(monkeypatch, piece):
    monkeypatch.setattr(contents, "_PIECE", piece)
    rng = random.Random(piece)
    for _ in range(300):
        text = bytes(rng.choices(b"ab\r\n", k=rng.randrange(12)))
        got = list(contents._lines(pa.BufferReader(text)))
        assert got == text.splitlines(), text


def test_many_and_long_lines(spark, tmp_path):
    rows = [b"%d" % i for i in range(25_000)] + [b"x" * 5_000_000]
    (tmp_path / "a.txt").write_bytes(gzip.compress(b"\n".join(rows)))
    got = lines_of(contents.read_lines(spark, str(tmp_path)))
    assert got == {"a.txt": sorted(rows)}


def test_a_cut_file_stops(spark, tmp_path):
    whole = gzip.compress(bytes(random.Random(1).choices(range(256), k=200_000)))
    (tmp_path / "cut.txt").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception, match="(?i)truncated|incomplete|unexpected"):
        contents.read_lines(spark, str(tmp_path)).count()


def test_no_files(spark, tmp_path):
    assert contents.packed_files(spark, str(tmp_path)).count() == 0
    assert contents.read_lines(spark, str(tmp_path)).count() == 0


def test_job(spark, tmp_path):
    base, root = str(tmp_path / "base"), tmp_path / "archive"
    names = {"d/a-UQ.txt": gzip.compress(b"G1.1\t1\n"), "d/b-UQ.txt.gz": b"G1.2\t3\nG2\t0\n"}
    for name, content in names.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)
    rows = [(*n.split("/"), "TXT", "P", f"c{i}", "b", "txt_list") for i, n in enumerate(names)]
    schema = f"{schemas.FILE_LIST}, batch string, list_table string"
    lists = spark.createDataFrame(rows, schema).write.partitionBy("batch", "list_table")
    lists.parquet(f"{base}/lists")
    jobs.run_expression(spark, base, str(root), by_content=True)
    stored = load_table(spark, f"{base}/gene_expr_table").collect()
    got = sorted((r.case_id, r.gene_id, r.gene_expr) for r in stored)
    assert got == [("c0", "G1", 1.0), ("c1", "G1", 3.0)]
    with pytest.raises(ValueError, match="names tell"):
        jobs.run_expression(spark, base, str(root), check_gzip=True, by_content=True)


def test_documents_as_the_plain_reader_has_them(spark, tmp_path):
    """In folders of any depth and name; hidden and empty files, other names, packed ones."""
    for name in ("a.xml", "d 1/é%20+.xml", "d2/in/b.xml", "_k=1/c.xml", "d2/e,f.xml"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(f"﻿<a>{name}</a>\n")
    for name in ("_x.xml", ".y.xml", "d2/z.txt", "_hidden/a.xml"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("<no/>")
    (tmp_path / "empty.xml").write_text("")
    root = str(tmp_path)
    for glob, under in (("*.xml", ""), ("{a,b}.xml", ""), ("[!a].xml", "d[2]"), (None, "d*"), ("*.gz", "")):
        want = files.read_documents(spark, root, glob, under).collect()
        got = contents.read_documents(spark, root, glob, under).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    (tmp_path / "packed.xml").write_bytes(gzip.compress(b"<b/>"))
    got = {r.filepath: r.value for r in contents.read_documents(spark, root).collect()}
    assert got["packed.xml"] == "<b/>" and len(got) == 6


def test_the_driver_holds_no_names_of_documents(spark, tmp_path):
    """Neither the scans of the plan nor its tasks grow with the number of files."""
    for k in range(500):
        folder = tmp_path / str(k % 5)
        folder.mkdir(exist_ok=True)
        (folder / f"{k}.xml").write_text(f"<a>{k}</a>")
    rows = contents.read_documents(spark, str(tmp_path))
    assert {r.value for r in rows.collect()} == {f"<a>{k}</a>" for k in range(500)}
    assert not any(f.endswith(".xml") for f in rows.inputFiles())
    assert rows.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
