"""The data model's tables, derived from the given ones.

Customers stand in for patients, parts for genes, order lines for measures and orders for
files. Quantities are whole numbers, so sums and means are exact in any order.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.functions.reports import CLINICAL_FIELDS
from oncolake.plans.cohorts import CohortSpec, like, stages

# One disease per shape of cohort: stage lists, overlapping patterns, single stages, a
# higher threshold, and a disease without stages.
SPECS = (
    CohortSpec("BUILDING", stages("I", "IA", "IB"), stages("II", "IIA", "IIB")),
    CohortSpec("AUTOMOBILE", like("Stage II"), like("Stage III")),
    CohortSpec("FURNITURE", stages("IIA"), stages("IIB")),
    CohortSpec("HOUSEHOLD", stages("IIIA"), stages("IIIB"), high=3.0),
    CohortSpec("MACHINERY", stages("I"), stages("II")),
    CohortSpec("TRUNK"),
)
STAGES = (
    *(f"Stage {n}" for n in ("I", "IA", "IB", "II", "IIA", "IIB", "III", "IIIA", "IIIB")),
    "N/A",
)


# The given tables that stand in for others, with the columns that are used.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_returnflag string, l_linestatus string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string"
    ),
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def spec_of(disease: str) -> CohortSpec:
    return next(s for s in SPECS if s.disease == disease)


def _one_of(values: tuple[str, ...], number: Column) -> Column:
    """The value at a position; null beyond the last."""
    return F.get(F.array(*map(F.lit, values)), number.cast("int"))


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("case_id"),
        F.col("c_nationkey").alias("project_id"),
        F.when(key % 13 != 0, F.col("c_mktsegment")).alias("disease_type"),
        _one_of(STAGES, key % 11).alias("disease_stage"),
        _one_of(("FEMALE", "MALE"), key % 3).alias("gender"),
    )


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(case_id, gene_id, gene_expr), zeros included."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", (F.col("l_quantity") - 1).alias("gene_expr")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("case_id"), F.col("l_partkey").alias("gene_id"), "gene_expr"
    )


def expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures(spark, sf_dir).filter(F.col("gene_expr") > 0)


def genome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 7th part has an id that no measure has, every 10th has two rows."""
    key = F.col("p_partkey")
    copies = F.when(key % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = table(spark, sf_dir, "part").select("*", F.explode(copies).alias("copy"))
    own = F.when(key % 7 == 0, -1 - key).otherwise(key)
    source = F.concat(F.lit(" [Source:"), F.col("p_brand"), F.lit("]"))
    return rows.select(
        F.concat(own.cast("string"), F.lit("."), F.col("copy").cast("string")).alias("full_id"),
        own.alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("chromosome"),
        F.when(F.col("copy") == 1, F.concat("p_type", source))
        .otherwise(F.col("p_type"))
        .alias("info"),
    )


def _file_name(key: Column) -> Column:
    suffix = F.when(key % 2 == 0, F.lit(".FPKM-UQ.txt.gz")).otherwise(F.lit(".xml"))
    return F.concat(F.lit("f"), key.cast("string"), suffix)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 19th file has a name that the metadata do not have."""
    key = F.col("o_orderkey")
    name = F.when(key % 19 == 0, F.concat(F.lit("listed-"), _file_name(key)))
    return table(spark, sf_dir, "orders").select(
        key.cast("string").alias("path"), name.otherwise(_file_name(key)).alias("filename")
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested, as the JSON input is; every 23rd file has a name that the manifest does not
    have, every 17th has no format."""
    key = F.col("o_orderkey")
    data_format = F.when(
        key % 17 != 0,
        F.when(key % 4 == 0, F.lit("BCR XML"))
        .when(key % 4 == 1, F.lit("TXT"))
        .when(key % 4 == 2, F.lit("XLSX"))
        .otherwise(F.lit("VCF")),
    )
    orders = table(spark, sf_dir, "orders")
    name = F.when(key % 23 == 0, F.concat(F.lit("described-"), _file_name(key)))
    customer = table(spark, sf_dir, "customer")
    case = F.struct(
        F.col("o_custkey").cast("string").alias("case_id"),
        F.struct(F.col("c_nationkey").cast("string").alias("project_id")).alias("project"),
    )
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        name.otherwise(_file_name(key)).alias("file_name"),
        data_format.alias("data_format"),
        F.array(case).alias("cases"),
    )


def expression_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(filepath, value): one file per order and one line per order line.

    Every 50th order has a value that is no number, so its whole file is rejected.
    """
    broken = (F.col("l_orderkey") % 50 == 0) & (F.col("l_linenumber") == 1)
    text = F.when(broken, F.lit("1.5f")).otherwise((F.col("l_quantity") - 1).cast("string"))
    return table(spark, sf_dir, "lineitem").select(
        order_path(F.col("l_orderkey")).alias("filepath"),
        F.concat(
            F.col("l_partkey").cast("string"),
            F.lit("."),
            F.col("l_linenumber").cast("string"),
            F.lit("\t"),
            text,
        ).alias("value"),
    )


def order_path(key: Column) -> Column:
    return F.concat(key.cast("string"), F.lit("/"), _file_name(key))


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(case_id, filepath) of all orders."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("case_id"),
        order_path(F.col("o_orderkey")).alias("filepath"),
    )


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(filepath, value): a namespaced XML report per customer.

    Every 7th has no stage element, every 5th an empty gender. A gender of another namespace
    stands before the right one, and a comment inside of it.
    """
    key = F.col("c_custkey")
    element = "<{0}>%s</{0}>".format
    stage = F.when(
        key % 7 != 0,
        F.format_string(
            "<stage:stage_event>" + element("stage:pathologic_stage") + "</stage:stage_event>",
            F.concat(F.lit("Stage "), F.col("c_nationkey").cast("string")),
        ),
    ).otherwise(F.lit(""))
    gender = F.when(key % 5 == 0, F.lit("<bio:gender/>")).otherwise(
        F.lit("<bio:gender>FE<!-- no break -->MALE</bio:gender>")
    )
    gender = F.concat(F.lit("<other:gender>UNKNOWN</other:gender>"), gender)
    site = F.format_string(element("site:tumor_tissue_site"), F.col("c_mktsegment"))
    prefixes = zip(("stage", "site", "bio"), CLINICAL_FIELDS, strict=True)
    declared = "".join(f' xmlns:{prefix}="{field.namespace}"' for prefix, field in prefixes)
    head = (
        f'<?xml version="1.0" encoding="UTF-8"?><bcr{declared} xmlns:other="urn:other"><patient>'
    )
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("r"), key.cast("string")).alias("filepath"),
        F.concat(F.lit(head), site, gender, stage, F.lit("</patient></bcr>")).alias("value"),
    )


def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(case_id, filepath): two reports for every third case, the neighbour's being later or
    earlier by path; some cases have none."""
    key = F.col("c_custkey")
    own = F.array(key)
    listed = F.when(key % 3 == 0, F.array(key, key - 1)).when(key % 11 != 0, own)
    return (
        table(spark, sf_dir, "customer")
        .select(key.alias("case_id"), F.explode(listed).alias("report"))
        .select("case_id", F.concat(F.lit("r"), F.col("report").cast("string")).alias("filepath"))
    )


def genome_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_name, value): a gene block per part, as the reader cuts them.

    Chromosomes are sizes 1..48, MT and none; every 9th block has no position pair, every
    13th is followed by an entry's end and sequence.
    """
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    file_name = (
        F.when(F.col("p_size") == 49, F.lit("Species.B1.1.chromosome.MT.dat.gz"))
        .when(F.col("p_size") == 50, F.lit("Species.B1.1.nonchromosomal.dat.gz"))
        .otherwise(F.concat(F.lit("Species.B1.1.chromosome."), size, F.lit(".dat.gz")))
    )
    span = F.when(key % 9 == 0, F.lit("<1..>20")).otherwise(
        F.concat(key.cast("string"), F.lit(".."), (key + 100).cast("string"))
    )
    location = F.when(key % 2 == 0, F.concat(F.lit("complement("), span, F.lit(")"))).otherwise(
        span
    )
    tail = F.when(key % 13 == 0, F.lit("\nORIGIN\n        1 acgt acgt\n//\n")).otherwise(
        F.lit('\n     mRNA            1..2\n                     /gene="other"')
    )
    pad = "                     "
    return table(spark, sf_dir, "part").select(
        file_name.alias("file_name"),
        F.concat(
            F.lit("           "),
            location,
            F.lit(f"\n{pad}/gene=G"),
            key.cast("string"),
            F.lit(f'.3\n{pad}/locus_tag="'),
            F.col("p_name"),
            F.lit(f'"\n{pad}/note="'),
            F.col("p_type"),
            F.lit(f"\n{pad}[Source:"),
            F.col("p_brand"),
            F.lit(']"'),
            tail,
        ).alias("value"),
    )


def pack_lines(lines: DataFrame, root: str, extension: str, packed: bool) -> None:
    """Writes (value) as text, one file for each task, under names of an extension that need not
    tell how they are packed. A task that runs again writes its file again."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(root if ":/" in root else f"file://{root}")
        store.create_dir(folder)
        name = f"{folder}/part-{TaskContext.get().partitionId():05d}-UQ.{extension}"
        with store.open_output_stream(name, compression="gzip" if packed else None) as out:
            for batch in batches:
                out.write("".join(f"{v}\n" for v in batch.column(0).to_pylist()).encode())
        yield pa.RecordBatch.from_pydict({"name": [name]})

    lines.select("value").mapInArrow(write, "name string").write.format("noop").mode(
        "overwrite"
    ).save()


def write_documents(documents: DataFrame, root: str) -> None:
    """Writes (filepath, value) as one text file each, in folders that hold a bounded share of them.
    A task that runs again writes the same files again."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(root if ":/" in root else f"file://{root}")
        part, made, count = f"{top}/{TaskContext.get().partitionId():05d}", set(), 0
        for batch in batches:
            for name, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                folder = f"{part}/{crc32(name.encode()) % 64:02d}"
                if folder not in made:
                    store.create_dir(folder)
                    made.add(folder)
                with store.open_output_stream(f"{folder}/{name}.txt", compression=None) as out:
                    out.write(f"{value}\n".encode())
                count += 1
        yield pa.RecordBatch.from_pydict({"files": [count]})

    dealt = documents.select("filepath", "value").repartition("filepath")
    dealt.mapInArrow(write, "files long").write.format("noop").mode("overwrite").save()
