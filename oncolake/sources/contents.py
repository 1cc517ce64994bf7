"""Files known by what they hold, not by their names.

Spark lists the files; a task opens each one that it was dealt through its URI, on any file
system that pyarrow reads, and takes the first bytes. Lines and records are unpacked as a stream,
so a task holds one piece of a file and the line or record that it is in. The line reader of `files` goes by names:
one that does not say how a file is packed would stop it, or make it take packed bytes for text.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.sources.arrays import partition_bytes, tasks_for
from oncolake.sources.files import (
    GENE_LINE,
    GENOME_FILES,
    SECTIONS,
    below_root,
    files_under,
    relative_path,
    resolved,
)
from oncolake.sources.opening import GZIP_MARK, is_gzip, look, opened
from oncolake.sources.tables import scratch_path

_PIECE = 1024 * 1024
#: Rows of one batch, at most, and their bytes, about.
_ROWS = 10_000
_BYTES = 4 * 1024 * 1024


def _listed(spark: SparkSession, root: str, glob: str | None, under: str) -> DataFrame:
    """(uri, filepath, length, modified) of the files below a prefix; nothing is read."""
    found = files_under(spark, glob).format("binaryFile").load(below_root(spark, root, under))
    return found.select(
        F.col("_metadata.file_path").alias("uri"),
        relative_path(spark, root).alias("filepath"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def _named_gzip() -> Column:
    return F.endswith(F.lower("filepath"), F.lit(".gz"))


def packed_files(
    spark: SparkSession, root: str, glob: str | None = None, under: str = ""
) -> DataFrame:
    """(filepath, length, modified, gzip, named_gzip) of the files below a prefix: whether a file
    starts as a gzip file, and whether its name says so.

    Two bytes of each file are read. A file of a single byte is no gzip file; one without any is
    not listed, as Spark's scans pass it over.
    """
    listed = _listed(spark, root, glob, under)
    looked = listed.mapInArrow(look, _schema(listed, "gzip boolean"))
    return looked.drop("uri").withColumn("named_gzip", _named_gzip())


def _schema(df: DataFrame, more: str) -> str:
    return ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in df.schema), more])


def gzip_files(
    spark: SparkSession, root: str, glob: str | None = None, under: str = ""
) -> DataFrame:
    """(filepath, length, modified) of the gzip files below a prefix, whatever their names."""
    return packed_files(spark, root, glob, under).filter("gzip").drop("gzip", "named_gzip")


def misnamed_files(
    spark: SparkSession, root: str, glob: str | None = None, under: str = ""
) -> DataFrame:
    """The rows of `packed_files` whose names and contents disagree."""
    return packed_files(spark, root, glob, under).filter("gzip <> named_gzip")


def _lines(stream: pa.NativeFile) -> Iterator[bytes]:
    """Lines as Spark's reader cuts them: at a line feed, a carriage return, or both."""
    rest: list[bytes] = []
    while piece := stream.read(_PIECE):
        if b"\n" not in piece and b"\r" not in piece and not (rest and rest[-1][-1:] == b"\r"):
            rest.append(piece)
            continue
        lines = b"".join([*rest, piece]).splitlines(keepends=True)
        # A carriage return at the end may be half of a line's end.
        rest = [] if lines[-1].endswith(b"\n") else [lines.pop()]
        yield from map(_unended, lines)
    if rest:
        yield _unended(b"".join(rest))


def _unended(line: bytes) -> bytes:
    """A line without its end."""
    if line.endswith(b"\r\n"):
        return line[:-2]
    return line[:-1] if line.endswith((b"\n", b"\r")) else line


def _records(stream: pa.NativeFile, mark: bytes, ends: Sequence[bytes]) -> Iterator[bytes]:
    """What follows each mark, to the next mark or to the first of the ends; what lies between an
    end and a mark is passed over and never held."""
    cut = re.compile(b"|".join(map(re.escape, (mark, *ends))))
    longest = max(map(len, (mark, *ends)))
    held, inside = b"", False
    while piece := stream.read(_PIECE):
        start, seek = 0, max(0, len(held) - longest + 1)
        held += piece
        while found := cut.search(held, seek):
            if inside:
                yield held[start : found.start()]
            inside = found[0] == mark
            start = seek = found.end()
        held = held[start if inside else max(start, len(held) - longest + 1) :]
    if inside:
        yield held


def _streamed(
    listed: DataFrame, pieces: Callable[[pa.NativeFile], Iterator[bytes]]
) -> DataFrame:
    """(filepath, value) of the pieces of every listed file, unpacked if it is a gzip file."""

    def batch_of(path: str, values: list[bytes]) -> pa.RecordBatch:
        paths = pa.DictionaryArray.from_arrays(pa.array([0] * len(values), pa.int32()), [path])
        return pa.RecordBatch.from_arrays(
            [paths.cast(pa.string()), pa.array(values, pa.binary())], ["filepath", "value"]
        )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                store, where = opened(file["uri"])
                packing = "gzip" if is_gzip(store, where) else None
                held, size = [], 0
                with store.open_input_stream(where, compression=packing) as stream:
                    for value in pieces(stream):
                        held.append(value)
                        size += len(value)
                        if len(held) == _ROWS or size >= _BYTES:
                            yield batch_of(file["filepath"], held)
                            held, size = [], 0
                if held:
                    yield batch_of(file["filepath"], held)

    rows = listed.select("uri", "filepath").mapInArrow(unpack, "filepath string, value binary")
    return rows.withColumn("value", F.col("value").cast("string"))


def read_lines(
    spark: SparkSession, root: str, glob: str | None = None, under: str = ""
) -> DataFrame:
    """(filepath, value) of every line of the files below a prefix, unpacked if they are gzip
    files by their contents; the bytes of a line are kept as they are.

    A file that does not unpack to its end stops the job. Each file is one task's work, plain
    ones too: where names can be trusted, `files.read_lines` cuts those.
    """
    return _streamed(_listed(spark, root, glob, under), _lines)


# -- archives of very many files


def _root_of(root: str) -> tuple[fs.FileSystem, str]:
    """Its file system and path. Here a percent sign stands for itself."""
    return opened(root.replace("%", "%25"))


def _hidden(name: str) -> bool:
    """What Spark's scans pass over."""
    plain = name.startswith("_") and "=" not in name
    return plain or name.startswith(".") or name.endswith("._COPYING_")


def _walked(spark: SparkSession, root: str, starts: list[str], glob: str | None) -> DataFrame:
    """(filepath, size) of the files in and below folders of the root, listed by tasks.

    A folder is one row, and its files are no rows on the driver. Each level of folders is a job.
    """

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _root_of(root)
        for batch in batches:
            for folder in batch.column("filepath").to_pylist():
                place = f"{top}/{folder}".rstrip("/")
                found = [
                    (f"{folder}/{i.base_name}".lstrip("/"), i.size, i.type == fs.FileType.Directory)
                    for i in store.get_file_info(fs.FileSelector(place))
                    if not _hidden(i.base_name)
                ]
                for at in range(0, len(found), _ROWS):
                    yield pa.RecordBatch.from_pylist(
                        [dict(zip(kinds.names, f, strict=True)) for f in found[at : at + _ROWS]], kinds
                    )

    kinds = pa.schema([("filepath", pa.string()), ("size", pa.int64()), ("folder", pa.bool_())])
    schema = "filepath string, size long, folder boolean"
    base, level = scratch_path(spark, "walked"), 0
    folders = spark.createDataFrame([(s,) for s in starts], "filepath string")
    while count := folders.count():
        tasks = min(count, 4 * spark.sparkContext.defaultParallelism)
        found = folders.repartition(tasks).mapInArrow(inside, schema)
        found.write.parquet(f"{base}/level={level}")
        folders = spark.read.schema(schema).parquet(f"{base}/level={level}").filter("folder")
        level += 1
    listed = spark.read.schema(f"{schema}, level int").parquet(base) if level else folders
    listed = listed.filter("NOT folder AND size > 0").select("filepath", "size")
    if glob:
        # The pattern as Spark's readers take it.
        named = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
        listed = listed.filter(F.substring_index("filepath", "/", -1).rlike(f"^(?:{named})$"))
    return listed


def read_documents(
    spark: SparkSession, root: str, glob: str | None = "*.xml", under: str = ""
) -> DataFrame:
    """(filepath, value), one row per file, without a byte order mark, unpacked if it is a gzip
    file by its contents.

    The rows of `files.read_documents`, for archives of any number of files: tasks list the
    folders, so the driver holds no names of files, and each task reads many.
    """
    top = resolved(spark, root)
    starts = [""]
    if under:
        path = spark._jvm.org.apache.hadoop.fs.Path(below_root(spark, root, under))
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        found = [f.getPath().toString() for f in store.globStatus(path) or [] if f.isDirectory()]
        starts = sorted(f.removeprefix(f"{top}/") for f in found)
    listed = _walked(spark, top, starts, glob)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _root_of(top)

        def batch_of(rows: list[tuple[str, bytes]]) -> pa.RecordBatch:
            names, values = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(values, pa.binary())], ["filepath", "value"]
            )

        for batch in batches:
            held, size = [], 0
            for name in batch.column("filepath").to_pylist():
                with store.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    value = stream.read()
                if value.startswith(GZIP_MARK):
                    value = gzip.decompress(value)
                held.append((name, value))
                size += len(value)
                if len(held) == _ROWS or size >= _BYTES:
                    yield batch_of(held)
                    held, size = [], 0
            if held:
                yield batch_of(held)

    count, size = listed.agg(F.count(F.lit(1)), F.sum("size")).first()
    cores = spark.sparkContext.defaultParallelism
    tasks = tasks_for(count, size or 0, partition_bytes(spark), cores)
    rows = listed.select("filepath").repartition(tasks)
    values = rows.mapInArrow(read, "filepath string, value binary")
    text = F.ltrim(F.col("value").cast("string"), F.lit("\ufeff"))
    # Documents are larger than their names, which adaptive execution takes them for.
    return values.select("filepath", text.alias("value")).hint("merge")


def read_genome_records(
    spark: SparkSession,
    root: str,
    layout: str = "genbank",
    glob: str | None = GENOME_FILES,
    under: str = "",
) -> DataFrame:
    """(file_name, value) of annotated genome files, one record for each gene: the text after a
    gene key, to the next one or to the end of the annotations.

    Sequences are passed over as they are unpacked, so no row and no task holds one. A file is
    one task's work; `files.read_genome_records` cuts large plain ones, but keeps sequences.
    """
    mark, ends = GENE_LINE[layout].encode(), [section.encode() for section in SECTIONS]
    records = _streamed(
        _listed(spark, root, glob, under), lambda stream: _records(stream, mark, ends)
    )
    return records.select(F.substring_index("filepath", "/", -1).alias("file_name"), "value")
