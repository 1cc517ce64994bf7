from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture
def duck():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection
