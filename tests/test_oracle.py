"""Every query against its SQL counterpart, values and column names."""

from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb
import pytest

from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return "\0" if value is None else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(ORACLES[name])
    want_columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(want_columns)
    got_rows = _rows(got.columns, got.collect())
    want_rows = _rows(want_columns, want.fetchall())
    assert len(got_rows) == len(want_rows)
    assert got_rows == want_rows
    assert got_rows
