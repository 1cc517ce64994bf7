"""Tables: one loader and one saver over any registered format."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from oncolake import schemas

# error: fail if the table exists; overwrite: replace it; append: add to it;
# ignore: leave an existing table as it is.
MODES = ("error", "overwrite", "append", "ignore")


def jdbc_options(
    url: str, user: str | None = None, password: str | None = None, driver: str | None = None
) -> dict[str, str]:
    """Connection options for load_table and save_table with format 'jdbc'."""
    options = {"url": url, "user": user, "password": password, "driver": driver}
    return {k: v for k, v in options.items() if v is not None}


def parallel_scan(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Options that read a JDBC table in ranges of a numeric column, one connection each."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def load_table(
    spark: SparkSession,
    name: str,
    fmt: str = "parquet",
    schema: str | StructType | None = None,
    **options: str,
) -> DataFrame:
    """A table by name or path. `fmt` is 'table' for the catalog, 'jdbc' for a database, or
    any file or connector format.

    A schema is needed for a partitioned table that may be empty, and keeps partition values
    that look like numbers as they are.
    """
    if fmt == "table":
        return spark.table(name)
    reader = spark.read.format(fmt).options(**options)
    if fmt == "jdbc":
        return reader.option("dbtable", name).load()
    return (reader.schema(schema) if schema else reader).load(name)


def save_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    mode: str = "error",
    partition_by: Sequence[str] = (),
    **options: str,
) -> None:
    """Write a table by name or path, in one of the four modes."""
    if mode not in MODES:
        raise ValueError(f"unknown save mode: {mode}")
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "table":
        writer.options(**options).saveAsTable(name)
    elif fmt == "jdbc":
        writer.format(fmt).options(dbtable=name, **options).save()
    else:
        writer.format(fmt).options(**options).save(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at a path of any file system that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    """A table of the data model without rows."""
    return spark.createDataFrame([], schemas.TABLES[table])


def create_table(
    spark: SparkSession, table: str, name: str, fmt: str = "parquet", **options: str
) -> None:
    """Drop a table of the data model, if it is there, and create it empty."""
    save_table(empty_table(spark, table), name, fmt, "overwrite", **options)


def save_bucketed(
    df: DataFrame, name: str, path: str, key: str, buckets: int, sort_by: str
) -> None:
    """Write a table whose rows are dealt to `buckets` by `key`, and sorted inside them.

    A join on the key with another side of any size then leaves these rows where they are.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key)
    writer.sortBy(sort_by).option("path", path).saveAsTable(name)


def load_bucketed(
    spark: SparkSession, name: str, path: str, schema: str, key: str, buckets: int, sort_by: str
) -> DataFrame:
    """The table that `save_bucketed` wrote, also in a session that does not know its name."""
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} ({schema}) USING parquet LOCATION '{path}' "
            f"CLUSTERED BY ({key}) SORTED BY ({sort_by}) INTO {buckets} BUCKETS"
        )
    return spark.table(name)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for an intermediate table, in the shared folder that the session names in
    spark.checkpoint.dir."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
