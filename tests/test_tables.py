from __future__ import annotations

import pytest

from oncolake import schemas
from oncolake.operators.serving import as_json, disease_menu, project_summary, select_patients
from oncolake.sources import tables


@pytest.fixture
def rows(spark):
    return spark.range(3)


def test_modes(spark, rows):
    path = tables.scratch_path(spark, "modes")
    tables.save_table(rows, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.save_table(rows, path)
    tables.save_table(rows, path, mode="ignore")
    assert tables.load_table(spark, path).count() == 3
    tables.save_table(rows, path, mode="append")
    assert tables.load_table(spark, path).count() == 6
    tables.save_table(rows, path, mode="overwrite")
    assert tables.load_table(spark, path).count() == 3
    with pytest.raises(ValueError):
        tables.save_table(rows, path, mode="merge")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_formats(spark, rows, fmt):
    path = tables.scratch_path(spark, fmt)
    tables.save_table(rows, path, fmt)
    assert sorted(r.id for r in tables.load_table(spark, path, fmt).collect()) == [0, 1, 2]


def test_catalog_tables(spark, rows):
    tables.save_table(rows, "three_rows", "table", "overwrite")
    tables.save_table(rows, "three_rows", "table", "append")
    assert tables.load_table(spark, "three_rows", "table").count() == 6
    spark.sql("DROP TABLE three_rows")


@pytest.mark.parametrize("table", sorted(schemas.TABLES))
def test_created_tables_are_empty_and_typed(spark, table):
    path = tables.scratch_path(spark, table)
    for _ in range(2):
        tables.create_table(spark, table, path)
        stored = tables.load_table(spark, path)
        assert stored.isEmpty()
        assert stored.schema == spark.createDataFrame([], schemas.TABLES[table]).schema


def test_jdbc_options():
    """Only the options are tested: no database is at hand."""
    assert tables.jdbc_options("jdbc:x://h/db", "me", "secret") == {
        "url": "jdbc:x://h/db",
        "user": "me",
        "password": "secret",
    }
    assert tables.parallel_scan("n", 0, 100, 8) == {
        "partitionColumn": "n",
        "lowerBound": "0",
        "upperBound": "100",
        "numPartitions": "8",
    }


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = tables.scratch_path(spark, "a"), tables.scratch_path(spark, "a")
    assert first != second
    assert first.startswith(shared)


def test_serving_edge_rows(spark):
    patients = spark.createDataFrame(
        [
            ("c1", "P", None, None, None),
            ("c2", "P", None, "N/A", None),
            ("c3", "Q", "A'b", "s", "x"),
        ],
        schemas.PATIENT_INFO,
    )
    summary = project_summary(patients)
    assert sorted(map(tuple, summary.collect()), key=repr) == [("A'b", "Q", 1), (None, "P", 2)]
    assert [tuple(r) for r in disease_menu(summary).collect()] == [("", ""), ("A'b", "A'b")]
    # A quote in a name is data, not syntax.
    assert select_patients(patients, "A'b").count() == 1
    assert as_json(patients.limit(1)).first().output == (
        '{"case_id":"c1","project_id":"P","disease_type":null,"disease_stage":null,"gender":null}'
    )
