"""Readers for the file inputs. One job reads a whole directory; nothing loops over files.

Each reader takes the `root` that file lists are relative to, and reads what lies `under` it:
everything, or a folder or pattern of folders. The driver holds the names of all files of one
read, so an archive of very many files is read in parts.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from oncolake import schemas
from oncolake.sources.arrays import read_objects

# Line layouts of annotated genome files, up to and including the key of a
# gene block.
GENE_LINE = {"genbank": "\n     gene ", "embl": "\nFT   gene "}
# A sequence section, or the end of an entry, ends the annotations.
SECTIONS = ("\nORIGIN", "\nSQ ", "\nXX", "\n//")
GENOME_FILES = "*dat.gz"
EXPRESSION_FILES = "*-UQ.txt*"

_PIECE = 64 * 1024


def resolved(spark: SparkSession, root: str) -> str:
    """The root as the file system names it: with its scheme, and without `..`, `.` and
    repeated slashes."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    # Two slashes at the start would name an authority.
    given = path("/" + root.lstrip("/") if root.startswith("/") else root)
    store = given.getFileSystem(spark._jsc.hadoopConfiguration())
    return path(store.makeQualified(given).toUri().normalize()).toString().rstrip("/")


def relative_path(spark: SparkSession, root: str) -> Column:
    """Path of the file a row comes from, below `root`, as it stands in a file list.

    The root must be what was read, as `resolved` names it. A file that does not lie below it
    stops the job.
    """
    below = resolved(spark, root) + "/"
    scheme, _, rest = below.partition(":/")
    # A root without an authority is written with one slash or with three.
    spelled = (below,) if rest.startswith("/") else (f"{scheme}:///{rest}", below)
    uri = F.col("_metadata.file_path")
    # File URIs are percent-encoded, but a plus sign stands for itself. Most have neither, and
    # this is evaluated for every line.
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(uri, F.lit("%")), _after(decoded, spelled)).otherwise(
        _after(uri, spelled)
    )


def _after(text: Column, starts: Sequence[str]) -> Column:
    strange = F.raise_error(F.concat(F.lit(f"not below {starts[-1]}: "), text))
    out = strange.cast("string")
    for start in starts:
        rest = F.substr(text, F.lit(len(start) + 1))
        out = F.when(F.startswith(text, F.lit(start)), rest).otherwise(out)
    return out


def read_metadata(
    spark: SparkSession, path: str, multi_line: bool = True, cut_bytes: int | None = None
) -> DataFrame:
    """Nested file metadata: arrays of objects, or with multi_line=False one object on each line.

    A file of either kind is cut into many tasks; arrays are read twice for that (`arrays`).
    """
    if not multi_line:
        return spark.read.schema(schemas.METADATA).json(path)
    entries = read_objects(spark, path, cut_bytes)
    return entries.select(F.from_json("value", schemas.METADATA).alias("entry")).select("entry.*")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, filename) of tab-separated manifests; quote characters are plain text.

    Every file's own header tells where the two declared columns stand; others are passed over.
    A file without them in its header stops the job.
    """
    lines = spark.read.text(path).filter("value != ''")
    fields = F.split("value", "\t")
    wanted = {name: F.array_position(fields, name) for name in schemas.MANIFEST}
    is_header = reduce(lambda a, b: a & b, (at > 0 for at in wanted.values()))
    marked = lines.select(
        F.col("_metadata.file_path").alias("file"),
        fields.alias("fields"),
        is_header.alias("header"),
        *(at.alias(f"_{name}") for name, at in wanted.items()),
    )
    # One row per manifest file.
    headers = marked.filter("header").select("file", *(f"_{name}" for name in wanted)).distinct()
    plain = marked.filter("NOT header").select("file", "fields")
    rows = plain.join(F.broadcast(headers), "file", "left")
    strange = F.raise_error(F.concat(F.lit("no header in "), F.col("file"))).cast("string")

    def value(name: str) -> Column:
        at = F.col(f"_{name}")
        field = F.nullif(F.get("fields", (at - 1).cast("int")), F.lit(""))
        return F.when(at.isNull(), strange).otherwise(field)

    return rows.select(value("id").alias("path"), value("filename").alias("filename"))


def files_under(spark: SparkSession, glob: str | None) -> DataFrameReader:
    """A reader of all files below a folder whose names match."""
    reader = spark.read.option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", glob) if glob else reader


def below_root(spark: SparkSession, root: str, under: str) -> str:
    """What lies `under` the root, as a path to read."""
    top = resolved(spark, root)
    return f"{top}/{under}" if under else f"{top}/"


def read_lines(
    spark: SparkSession, root: str, glob: str | None = EXPRESSION_FILES, under: str = ""
) -> DataFrame:
    """(filepath, value) of every line; compressed files are unpacked by their extension."""
    lines = files_under(spark, glob).text(below_root(spark, root, under))
    return lines.select(relative_path(spark, root).alias("filepath"), "value")


def read_documents(
    spark: SparkSession, root: str, glob: str | None = "*.xml", under: str = ""
) -> DataFrame:
    """(filepath, value), one row per file, without a byte order mark."""
    documents = files_under(spark, glob).text(below_root(spark, root, under), wholetext=True)
    text = F.ltrim(F.col("value"), F.lit("\ufeff"))
    return documents.select(relative_path(spark, root).alias("filepath"), text.alias("value"))


def read_elements(
    spark: SparkSession,
    root: str,
    row_tag: str,
    schema: str,
    glob: str | None = None,
    under: str = "",
) -> DataFrame:
    """(filepath, fields of the schema), one row per `row_tag` element in any file."""
    reader = files_under(spark, glob).format("xml").schema(schema).option("rowTag", row_tag)
    elements = reader.load(below_root(spark, root, under))
    return elements.select(relative_path(spark, root).alias("filepath"), "*")


def read_genome_records(
    spark: SparkSession,
    root: str,
    layout: str = "genbank",
    glob: str | None = GENOME_FILES,
    under: str = "",
) -> DataFrame:
    """(file_name, value): text cut at each gene line, so one record starts with one gene.

    The cut is made by the reader, at the byte level: a record never depends on the lines of
    another, and large plain files are split over tasks. The record of the last gene before a
    sequence holds that sequence too: a task needs memory for the longest one.
    """
    records = files_under(spark, glob).text(below_root(spark, root, under), lineSep=GENE_LINE[layout])
    return records.select(F.col("_metadata.file_name").alias("file_name"), "value")


def list_files(
    spark: SparkSession, root: str, glob: str | None = "*.gz", under: str = ""
) -> DataFrame:
    """(filepath, length, modified) of the files below a prefix; contents are not read."""
    found = files_under(spark, glob).format("binaryFile").load(below_root(spark, root, under))
    return found.select(
        relative_path(spark, root).alias("filepath"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


@F.pandas_udf(BooleanType())
def _unpacks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Whether each blob is a complete gzip stream; unpacked piece by piece, nothing is kept."""

    def unpacks(blob: bytes) -> bool:
        stream = None
        try:
            for start in range(0, len(blob), _PIECE):
                piece = blob[start : start + _PIECE]
                while piece:
                    if stream is None or stream.eof:
                        stream = zlib.decompressobj(wbits=31)
                    stream.decompress(piece)
                    piece = stream.unused_data
        except zlib.error:
            return False
        return stream is not None and stream.eof

    for blobs in batches:
        yield blobs.map(unpacks).astype(bool)


def damaged_gzip_files(
    spark: SparkSession, root: str, glob: str | None = "*.gz", under: str = ""
) -> DataFrame:
    """(filepath) of files that do not unpack to their end.

    The line reader stops a job at such a file. Where damaged files are expected, list them
    with this, read with `spark.sql.files.ignoreCorruptFiles` set, and add the list to the
    rejected files: what was read of them before the damage is then dropped with them.
    """
    blobs = files_under(spark, glob).format("binaryFile").load(below_root(spark, root, under))
    path = relative_path(spark, root).alias("filepath")
    checked = blobs.select(path, _unpacks("content").alias("_whole"))
    return checked.filter(~F.col("_whole")).select("filepath")
