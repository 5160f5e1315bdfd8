"""Byte ranges of binary files in the shared folder, or any store that Arrow can open."""

from __future__ import annotations

from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Most tasks that blocks are dealt to.
TASKS = 20_000


def dealt(rows: DataFrame, n: int) -> DataFrame:
    """Narrow rows that stand for much work each, dealt out in turn to ``n`` tasks (at most TASKS).  The
    number is explicit: an adaptive plan would merge them into one task by their few bytes."""
    return rows.repartition(max(1, min(n, TASKS)))


def blocks(spark: SparkSession, path: str, size: int) -> DataFrame:
    """path, length, first and last (exclusive) byte of each block of every non-empty file, a block to
    a task.  Only the files' sizes are read."""
    found = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    n = found.agg(F.sum(F.ceil(F.col("length") / size)).alias("n")).collect()[0]["n"] or 0
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long")))
    return dealt(found.select("path", "length", first.alias("first"))
                 .withColumn("last", F.least(F.col("first") + size, F.col("length"))), n)


def read(uri: str, first: int, last: int) -> bytes:
    """Bytes first .. last of a file."""
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as f:
        f.seek(first)
        return f.read(last - first)


def grouped(rows: Iterator[tuple], limit: int) -> Iterator[list[tuple]]:
    """Lists of (size, row)s whose sizes reach about ``limit``."""
    held, size = [], 0
    for n, row in rows:
        held.append(row)
        size += n
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held
