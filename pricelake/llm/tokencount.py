"""Token counts of documents in flat token files, by a separator scan.

A token file is nothing but 16-bit little-endian ids, each document followed by the end-of-document
id; there is no index.  Files are read in blocks by independent tasks, which find the separators of
a block with one numpy comparison.  A document that lies over blocks is stitched by a prefix scan:
for every block the number of separators before it, and the place of the last one, are running
sums and maxima over one narrow row per block.

Writing: every document is encoded by a public rank file; Spark's text sink writes the ids, with
the end-of-document id as its line separator.  ``numbered`` gives the part and place that each
document has in those files, from the same splits of the same table; the counts per part are
compared when the two meet.

Cases: a null or empty text is a document of 0 tokens; texts are taken whole; repeated rows are
documents of their own; ids of ends cannot occur in a text; tokens after a file's last end are a
document that is not ``ended``; an empty file holds no document; an odd byte at a file's end is
ignored; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import vocabulary
from .common import stored
from .files import blocks, read
from .textscan import pieces

#: Bytes of a block; even, as an id has two.
BLOCK = 4 << 20
#: Bytes of text encoded at once.
PIECE = 1 << 19


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=vocabulary(path), special_tokens={})


def write(docs: DataFrame, folder: str, path: str, pattern: str, end: int) -> None:
    """Token files of ``docs`` (text) under ``folder``, one per partition, in the order of rows."""
    if max(vocabulary(path).values()) >= end or end >= 1 << 16:
        raise ValueError("the end-of-document id must be free and below 65536")

    def run(batches):
        tok = encoding(path, pattern)
        for batch in batches:
            for lo, hi, _, _ in pieces(batch.column(0), PIECE):
                texts = batch.column(0).slice(lo, hi - lo).fill_null("").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([np.array(tok.encode_ordinary(t), "<u2").tobytes() for t in texts], pa.binary())], names=["ids"])

    ids = docs.select("text").mapInArrow(run, "ids binary").select(F.col("ids").cast("string").alias("value"))
    mark = end.to_bytes(2, "little").decode("latin-1")
    ids.write.option("lineSep", mark).option("encoding", "ISO-8859-1").option("compression", "none").text(folder)


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, part, place: the partition of each row and its place there."""
    return docs.select("doc_id", F.monotonically_increasing_id().alias("at")).select(
        "doc_id", F.shiftright("at", 33).cast("int").alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("place"))


def count(spark: SparkSession, folder: str, end: int, size: int = BLOCK) -> DataFrame:
    """path, place (from 0), start (token), n_tokens, ended of every document of the files."""

    def run(batches):
        for batch in batches:
            for uri, length, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(read(uri, first, last - (last - first) % 2), "<u2")
                at = np.flatnonzero(ids == end) + first // 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri]), pa.array([first]), pa.array([length // 2]), pa.array([last == length]),
                     pa.array([len(at)]), pa.array([int(at[-1]) if len(at) else None], pa.int64()),
                     pa.array([at], pa.list_(pa.int64()))],
                    names=["path", "first", "total", "final", "n", "last_end", "ends"])

    found = stored(blocks(spark, folder, size).mapInArrow(
        run, "path string, first long, total long, final boolean, n long, last_end long, ends array<long>"), "token-ends")
    before = Window.partitionBy("path").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    scan = found.select("path", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("docs_before"),
                        F.coalesce(F.max("last_end").over(before), F.lit(-1)).alias("end_before"))
    met = found.join(stored(scan, "token-scan"), ["path", "first"])
    tail = F.col("total") - 1 - F.coalesce("last_end", "end_before")
    open_ = F.when(F.col("final") & (tail > 0), F.array(F.col("total"))).otherwise(F.array().cast("array<long>"))
    cut = F.concat("ends", open_)
    return (met.withColumn("cut", cut).withColumn("from", F.concat(F.array("end_before"), "ends"))
            .select("path", "docs_before", "from", "n", F.posexplode("cut").alias("k", "stop"))
            .select("path", (F.col("docs_before") + F.col("k")).alias("place"),
                    (F.element_at("from", F.col("k") + 1) + 1).alias("start"),
                    (F.col("stop") - F.element_at("from", F.col("k") + 1) - 1).alias("n_tokens"),
                    (F.col("k") < F.col("n")).alias("ended")))


def with_ids(counted: DataFrame, rows: DataFrame) -> DataFrame:
    """doc_id, n_tokens of every counted document; fails if a part's number of documents differs."""
    counted = counted.select(F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("int").alias("_part"),
                             F.col("place").alias("_place"), "n_tokens")
    both = rows.join(counted, (F.col("part") == F.col("_part")) & (F.col("place") == F.col("_place")), "full")
    lost = F.col("part").isNull() | F.col("_part").isNull()
    return both.select("doc_id", F.when(lost, F.raise_error(F.lit("token files and documents differ"))).otherwise(F.col("n_tokens"))
                       .cast("long").alias("n_tokens"))
