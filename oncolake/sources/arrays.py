"""JSON arrays that are written over several lines, read by many tasks to a file.

Where an object starts depends on all that is before it: whether a brace is inside a string, and
how deep it stands. So a file is cut into ranges of bytes, and each range is first summed up for
both cases, as if it began inside a string and as if it began outside: how many levels it opens,
and whether its quotes are odd. These sums, one row for each range, give every range its start by a
window over the file. Then each range gives the objects that begin in it, and reads on to the
end of the last. A file that is one range is read once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oncolake.sources.opening import look, opened

_PIECE = 1024 * 1024
#: Objects of one batch, at most, and their bytes, about.
_ROWS = 5_000
_BYTES = 4 * 1024 * 1024
#: Tasks for each core, so that uneven ones even out.
_PER_CORE = 4

_BACKSLASH, _QUOTE = ord("\\"), ord('"')
_LEVEL = np.zeros(256, np.int8)
_LEVEL[[ord("{"), ord("[")]] = 1
_LEVEL[[ord("}"), ord("]")]] = -1


def _plain_quotes(data: np.ndarray, escaped: bool) -> tuple[np.ndarray, bool]:
    """Which bytes are quotes that no backslash escapes; and whether the byte after is escaped."""
    quotes = data == _QUOTE
    slashes = np.flatnonzero(data == _BACKSLASH)
    if escaped:
        quotes[:1] = False
        slashes = slashes[slashes > 0]
    if not len(slashes):
        return quotes, escaped and not len(data)
    # Of a run of backslashes every other one escapes what follows it.
    first = np.r_[True, np.diff(slashes) > 1]
    begins = np.maximum.accumulate(np.where(first, np.arange(len(slashes)), 0))
    active = slashes[(np.arange(len(slashes)) - begins) % 2 == 0] + 1
    quotes[active[active < len(data)]] = False
    return quotes, bool(active[-1] == len(data))


def _is_escaped(stream: pa.NativeFile, start: int) -> bool:
    """Whether the backslashes before a place escape what stands there."""
    run = 0
    while start > run:
        size = min(4096, start - run)
        stream.seek(start - run - size)
        piece = stream.read(size)
        here = size - len(piece.rstrip(b"\\"))
        run += here
        if here < size:
            break
    return run % 2 == 1


def _sum_up(stream: pa.NativeFile, start: int, end: int) -> tuple[bool, int, int]:
    """Whether the quotes of a range are odd; its change of level if it begins outside a string,
    and if it begins inside one."""
    escaped, odd, outside, inside = _is_escaped(stream, start), False, 0, 0
    stream.seek(start)
    while start < end and (piece := stream.read(min(_PIECE, end - start))):
        start += len(piece)
        data = np.frombuffer(piece, np.uint8)
        quotes, escaped = _plain_quotes(data, escaped)
        within = (np.cumsum(quotes) + odd) % 2 == 1
        levels = _LEVEL[data]
        outside += int(levels[~within].sum(dtype=np.int64))
        inside += int(levels[within].sum(dtype=np.int64))
        odd ^= bool(quotes.sum() % 2)
    return odd, outside, inside


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies after a range needs its sum; the last of a file is not read."""
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            if row["last"]:
                found.append((False, 0, 0))
                continue
            store, path = opened(row["uri"])
            with store.open_input_file(path) as stream:
                found.append(_sum_up(stream, row["start"], row["end"]))
        for name, kind, k in (("odd", pa.bool_(), 0), ("out", pa.int64(), 1), ("into", pa.int64(), 2)):
            batch = batch.append_column(name, pa.array([f[k] for f in found], kind))
        yield batch


def _element_level(stream: pa.NativeFile) -> int:
    """The level that the objects stand at: 1 in an array, 0 if the file is an object itself."""
    while piece := stream.read(4096):
        if text := piece.removeprefix(b"\xef\xbb\xbf").lstrip(b" \t\r\n"):
            return 1 if text[:1] == b"[" else 0
    return 0


def _objects(
    stream: pa.NativeFile, at: int, end: int | None, within: bool, level: int, top: int, escaped: bool
) -> Iterator[bytes]:
    """The objects that begin at level `top` before the place `end`, from a stream that is at `at`."""
    held: list[bytes] = []
    while (end is None or at < end or held) and (piece := stream.read(_PIECE)):
        data = np.frombuffer(piece, np.uint8)
        quotes, escaped = _plain_quotes(data, escaped)
        inside = (np.cumsum(quotes) + within) % 2 == 1
        steps = np.where(inside, 0, _LEVEL[data])
        levels = np.cumsum(steps, dtype=np.int64) + level
        braces = (data == ord("{")) | (data == ord("}"))
        begins = (steps == 1) & braces & (levels == top + 1)
        ends = (steps == -1) & braces & (levels == top)
        since = 0 if held else None
        for place in np.flatnonzero(begins | ends).tolist():
            if begins[place]:
                if end is not None and at + place >= end:
                    return
                since = place
            elif since is not None:
                yield b"".join([*held, piece[since : place + 1]])
                held, since = [], None
                if end is not None and at + place >= end:
                    return
        if since is not None:
            held.append(piece[since:])
        within, level, at = bool(inside[-1]), int(levels[-1]), at + len(piece)
    if held:
        raise ValueError("the file ends inside an object")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            store, path = opened(row["uri"])
            packing = "gzip" if row["gzip"] else None
            with store.open_input_stream(path, compression=packing) as stream:
                top = _element_level(stream)
            if row["gzip"]:
                source, end, escaped = store.open_input_stream(path, compression="gzip"), None, False
            else:
                source, end = store.open_input_file(path), row["end"]
                escaped = _is_escaped(source, row["start"])
                source.seek(row["start"])
            with source:
                held, size = [], 0
                state = row["start"], end, row["within"], row["level"], top, escaped
                for value in _objects(source, *state):
                    held.append(value)
                    size += len(value)
                    if len(held) == _ROWS or size >= _BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])


def partition_bytes(spark: SparkSession) -> int:
    """What one task of a scan reads at most, in bytes; a session may write it with a unit."""
    set_ = spark.conf.get("spark.sql.files.maxPartitionBytes")
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(set_))


def tasks_for(ranges: int, size: int, most: int, cores: int) -> int:
    """Tasks for ranges of so many bytes in all: some for each core, and more only if one would
    read more than `most` bytes. The driver's share grows with tasks, so small ranges share one."""
    return max(2, min(ranges, max(_PER_CORE * cores, -(-size // most))))


def read_objects(spark: SparkSession, path: str, cut_bytes: int | None = None) -> DataFrame:
    """(value) of every object in files that hold an array of objects each, or objects alone, as
    the text that stands there.

    Files are UTF-8, of any layout; gzip files, known by their contents, are one task each, others
    cut into ranges of `cut_bytes` (by default spark.sql.files.maxPartitionBytes). A task takes
    several ranges if there are many, as Spark's scans do with small files. Elements of an
    array that are no objects, and empty files, give nothing. A file that ends inside an object
    stops the job. A task holds one object and one piece of a megabyte.
    """
    most = partition_bytes(spark)
    if cut_bytes is None:
        cut_bytes = most
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    listed = found.select(F.col("_metadata.file_path").alias("uri"), "length")
    looked = listed.mapInArrow(look, "uri string, length long, gzip boolean")
    step = F.when(F.col("gzip"), F.col("length")).otherwise(F.lit(cut_bytes))
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, step)
    ranges = looked.select("uri", "length", "gzip", F.explode(starts).alias("start")).select(
        "uri",
        "gzip",
        "start",
        F.least("length", F.col("start") + cut_bytes).alias("end"),
        (F.col("gzip") | (F.col("start") + cut_bytes >= F.col("length"))).alias("last"),
    )
    # A row stands for many bytes, which adaptive execution does not see: a given number of
    # partitions is left as it is.
    count, size = listed.agg(F.sum(F.ceil(F.col("length") / cut_bytes)), F.sum("length")).first()
    tasks = tasks_for(count or 0, size or 0, most, spark.sparkContext.defaultParallelism)
    schema = "uri string, gzip boolean, start long, end long, last boolean, odd boolean, out long, into long"
    summed = ranges.repartition(tasks).mapInArrow(_sums, schema)
    before = Window.partitionBy("uri").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)

    def so_far(value: Column) -> Column:
        return F.coalesce(F.sum(value).over(before), F.lit(0))

    begun = summed.withColumn("within", so_far(F.col("odd").cast("int")) % 2 == 1).withColumn(
        "level", so_far(F.when(F.col("within"), F.col("into")).otherwise(F.col("out")))
    )
    rows = begun.repartition(tasks).mapInArrow(_cut, "value binary")
    # Adaptive execution takes the objects for as small as the ranges they come from, and would
    # have the driver collect and copy them in a join.
    return rows.select(F.col("value").cast("string").alias("value")).hint("merge")
