"""Arrays of objects cut into ranges of bytes, against a parser of whole files."""

from __future__ import annotations

import gzip
import io
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from oncolake.operators import catalog
from oncolake.sources import arrays, files

STRANGE = ['"', "\\", '\\"', "{", "}", "[", "]", "},{", "é中", "\n", "a", ""]

texts = st.lists(st.sampled_from(STRANGE), max_size=6).map("".join)
values = st.recursive(
    texts | st.integers() | st.none(),
    lambda v: st.lists(v, max_size=3) | st.dictionaries(texts, v, max_size=3),
    max_leaves=8,
)


def cut(data: bytes, step: int) -> list[bytes]:
    """The objects of all ranges, each from the state that the sums give it."""
    out, within, level = [], False, 0
    top = arrays._element_level(io.BytesIO(data))
    for start in range(0, len(data), step):
        stream, end = io.BytesIO(data), min(len(data), start + step)
        escaped = arrays._is_escaped(stream, start)
        stream.seek(start)
        out += arrays._objects(stream, start, end, within, level, top, escaped)
        odd, outside, inside = arrays._sum_up(io.BytesIO(data), start, end)
        level += inside if within else outside
        within ^= odd
    return out


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.dictionaries(texts, values, max_size=4) | values, max_size=6),
    st.sampled_from([None, 2]),
    st.booleans(),
    st.integers(1, 40),
    st.integers(1, 30),
)
def test_ranges_of_any_size(entries, indent, plain, step, piece):
    data = json.dumps(entries, indent=indent, ensure_ascii=plain).encode()
    before = arrays._PIECE
    arrays._PIECE = piece
    try:
        got = [json.loads(o) for o in cut(data, step)]
    finally:
        arrays._PIECE = before
    assert got == [e for e in entries if isinstance(e, dict)]


@pytest.mark.parametrize("run", range(1, 9))
@pytest.mark.parametrize("step", [1, 3, 4096])
def test_runs_of_backslashes(run, step):
    entries = [{"a": "\\" * run + '"{'}, {"b": "}" + '\\"' * run}]
    assert [json.loads(o) for o in cut(json.dumps(entries).encode(), step)] == entries


def test_whole_objects_and_broken_ones():
    assert cut(b'\xef\xbb\xbf {"a": {"b": [{}]}}\n', 5) == [b'{"a": {"b": [{}]}}']
    assert cut(b"", 5) == cut(b" \n", 1) == cut(b"[]", 1) == cut(b"[1, null, [{}]]", 2) == []
    with pytest.raises(ValueError):
        cut(b'[{"a": 1}, {"a": 2', 4)


def entries_of(count):
    rng = random.Random(5)
    return [
        {
            "file_name": f"f{i}" + rng.choice(STRANGE),
            "data_format": rng.choice(["TXT", None, "BCR XML"]),
            "cases": [{"case_id": f"c{i}", "project": {"project_id": rng.choice(STRANGE)}}],
            "more": {"file_name": "inner", "cases": [{}]},
        }
        for i in range(count)
    ]


def test_one_file_is_many_tasks(spark, tmp_path):
    entries = entries_of(3000)
    (tmp_path / "big é+%.json").write_text(json.dumps(entries, indent=2, ensure_ascii=False))
    text = json.dumps(entries[:50], indent=1)
    (tmp_path / "packed.json").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "one.json").write_text(json.dumps(entries[7]))
    (tmp_path / "empty.json").write_text("")
    rows = files.read_metadata(spark, str(tmp_path), cut_bytes=64 * 1024)
    # The reader of whole files goes by names, so it does not see the packed one as such.
    plain = spark.read.schema(rows.schema).json(f"{tmp_path}/[bo]*.json", multiLine=True)
    packed = spark.read.schema(rows.schema).json(
        spark.sparkContext.parallelize(map(json.dumps, entries[:50]))
    )
    want = plain.unionByName(packed)
    assert sorted(map(str, rows.collect())) == sorted(map(str, want.collect()))
    assert rows.count() == 3051
    used = rows.selectExpr("spark_partition_id() AS p").distinct().count()
    assert used >= 8


def test_tasks_grow_with_bytes_not_with_ranges(spark, tmp_path):
    """Many small files share tasks; one range alone is no single partition either."""
    assert arrays.tasks_for(1, 10, 1000, 8) == 2
    assert arrays.tasks_for(10_000, 10_000_000, 10_000_000, 8) == 8 * arrays._PER_CORE
    assert arrays.tasks_for(10_000, 10_000_000, 100_000, 8) == 100
    entries = entries_of(400)
    for k, entry in enumerate(entries):
        (tmp_path / f"{k}.json").write_text(json.dumps([entry]))
    rows = files.read_metadata(spark, str(tmp_path), cut_bytes=64)
    assert sorted(r.file_name for r in rows.collect()) == sorted(e["file_name"] for e in entries)
    cores = spark.sparkContext.defaultParallelism
    assert rows.rdd.getNumPartitions() <= arrays._PER_CORE * cores


def test_objects_are_not_copied_for_a_join(spark, tmp_path):
    """The ranges are few bytes, what is read from them is not."""
    entries = entries_of(2000)
    (tmp_path / "a.json").write_text(json.dumps(entries))
    names = spark.createDataFrame([(e["file_name"], "p") for e in entries], "filename string, path string")
    for each_case in (False, True):
        rows = files.read_metadata(spark, str(tmp_path), cut_bytes=64 * 1024)
        index = catalog.build_index(names, rows, each_case)
        assert index.count() == sum(e["data_format"] is not None for e in entries)
        index.collect()
        plan = index._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "BroadcastHashJoin" not in plan


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "none.json").write_text("[]")
    assert files.read_metadata(spark, str(tmp_path / "none.json")).collect() == []
    (tmp_path / "broken.json").write_text('[{"file_name": "a"}, {"file_na')
    with pytest.raises(Exception, match="inside an object"):
        files.read_metadata(spark, str(tmp_path / "broken.json")).collect()
