"""Archives: round trips, what is passed over, and roles of equal payloads."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pytest

from oncolake.llm import warc
from oncolake.llm.queries import op3_warc

SF = "/root/testdata/sf0.01"
DATE = "2024-01-01T00:00:00Z"
ROWS = [
    (1, "http://a.org/x", "<p>same</p>", "c1"),
    (5, "http://a.org/y\r\nWARC-Type: fake", "<p>same</p>", "c2"),
    (3, None, "WARC/1.1\r\nWARC-Type: response\r\n\r\n<p>é中</p>\r\n\r\n", None),
    (4, "http://b.org", None, "c"),
    (9, "http://b.org", "", "c"),
    (7, "http://long", "x" * 300_000, "c"),
    (7, "http://long", "x" * 300_000, "c"),
    (None, "http://none", "<p>only</p>", "c"),
    (None, None, "<p>same</p>", None),
]


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string")


def brute(rows, least=0):
    best = {}
    for id_, html in rows:
        if id_ is not None:
            best[html or ""] = max(id_, best.get(html or "", id_))
    out = []
    for id_, html in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        first = best.get(html or "") if len(raw) >= least else None
        revisit = first is not None and first != id_
        out.append(
            (id_, len(raw), digest, "revisit" if revisit else "response", first if revisit else None)
        )
    return sorted(out, key=repr)


def read_back(spark, path, **options):
    rows = warc.read(spark, path, **options).collect()
    number = lambda v: int(v.rsplit(":", 1)[1]) if v and not v.endswith("none") else None
    return rows, sorted(
        (
            (number(r.record_id), r.payload_bytes, r.payload_digest[5:], r.record_type,
             number(r.refers_to))
            for r in rows
        ),
        key=repr,
    )


@pytest.mark.parametrize("least", [0, 5])
@pytest.mark.parametrize("level", ["3", "0"])
def test_round_trip(spark, tmp_path, level, least):
    path = str(tmp_path / "a")
    records = warc.page_records(pages_of(spark, ROWS), DATE, least_bytes=least)
    warc.write(records, path, level=level, fileBytes="1000")
    want = brute([(r[0], r[2]) for r in ROWS], least)
    for payload in ("read", "verify", "skip"):
        rows, got = read_back(spark, path, payload=payload)
        assert got == want
        bodies = sorted(bytes(r.payload) for r in rows if r.payload is not None)
        responses = [r for r in rows if r.record_type == "response"]
        if payload == "read":
            assert len(bodies) == len(responses)
            assert "x".encode() * 300_000 in bodies and ROWS[2][2].encode() in bodies
        else:
            assert bodies == []
    assert {r.target_uri for r in rows} >= {None, "http://a.org/y%0D%0AWARC-Type: fake"}
    assert {r.content_type for r in rows} == {"text/html; charset=utf-8"}


def test_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "a")
    records = warc.page_records(pages_of(spark, ROWS[:2]), DATE)
    for mode, count in (("append", 2), ("append", 4), ("overwrite", 2)):
        warc.write(records, path, mode)
        assert warc.read(spark, path).count() == count


def test_predicates_reach_the_reader(spark, tmp_path):
    path = str(tmp_path / "a")
    warc.write(warc.page_records(pages_of(spark, ROWS), DATE), path)
    found = warc.read(spark, path).filter("record_type = 'revisit' AND target_uri LIKE 'http://a%'")
    assert [r.record_id for r in found.collect()] == ["urn:x-page:1"]
    kept = warc.read(spark, path).filter("record_id IN ('urn:x-page:3') OR payload_bytes = 0")
    assert kept.count() == 3
    reader = warc.WarcReader({"path": path})
    tests = [warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("content_type",), "x"),
             warc.StringStartsWith(("target_uri",), "http://a")]
    assert list(reader.pushFilters(tests)) == [tests[1]]
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [r["record_id"] for r in rows] == ["urn:x-page:1"]


class Counting(io.BytesIO):
    def read(self, size=-1):
        data = super().read(size)
        self.seen = getattr(self, "seen", 0) + len(data)
        return data


@pytest.mark.parametrize("form", ["plain", "own", "foreign"])
def test_unwanted_payloads_are_passed_over(form):
    import random

    noise = bytes(random.Random(5).choices(range(256), k=500_000))
    base = dict.fromkeys(warc.SCHEMA.names) | {"record_type": "response", "date": DATE}
    raw = [
        warc.record_bytes(base | {"record_id": f"<r{k}>", "payload": noise if k % 2 else b"small"})
        for k in range(6)
    ]
    packed = {"plain": lambda d: d, "own": lambda d: warc.gzip_member(d, 6), "foreign": gzip.compress}
    file = Counting(b"".join(map(packed[form], raw)))
    got = list(warc.records(file, lambda row: row["record_id"] in ("r0", "r4"), "read"))
    assert [(r["record_id"], r["payload"]) for r in got] == [("r0", b"small"), ("r4", b"small")]
    assert form == "foreign" or file.seen < 100_000
    every = list(warc.records(io.BytesIO(file.getvalue()), payload="verify"))
    assert [r["payload_bytes"] for r in every] == [5, 500_000] * 3
    if form != "plain":
        assert gzip.decompress(file.getvalue()) == b"".join(raw)


def test_damage_is_found():
    row = dict.fromkeys(warc.SCHEMA.names) | {"record_type": "response", "payload": b"abc"}
    good = warc.record_bytes(row | {"record_id": "<r>"})
    with pytest.raises(ValueError, match="digest"):
        list(warc.records(io.BytesIO(good.replace(b"abc", b"abd")), payload="verify"))
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records(io.BytesIO(good[:-20])))
    with pytest.raises(ValueError, match="no record"):
        list(warc.records(io.BytesIO(b"junk\r\n\r\n")))


def test_partitions_are_balanced(tmp_path):
    for k in range(20):
        (tmp_path / f"{k}.warc").write_bytes(b"x" * (100 + 40 * k))
    parts = warc.WarcReader({"path": str(tmp_path), "partitionbytes": "2000"}).partitions()
    sizes = [sum(s for _, s in p.files) for p in parts]
    assert len(sizes) == 5 and max(sizes) - min(sizes) < 200
    assert sum(len(p.files) for p in parts) == 20


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "a")
    warc.write(warc.page_records(pages_of(spark, []), DATE), path)
    assert warc.read(spark, path).collect() == []


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = sorted(map(tuple, op3_warc(spark, SF).collect()), key=repr)
    assert got == brute([(p.page_id, p.html) for p in pages])
