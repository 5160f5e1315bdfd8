"""A table in month folders, published in layers under a committed manifest.

A full refresh writes every month of the table into one layer.  An increment writes a new layer: the
months where a row of the batch replaces a published one are written whole, merged by key; to all
other months the batch's rows are added as one more folder, so a usual day costs its own rows
and not its month.  A month of more than FOLDERS folders is folded into one again, also by ``fold``
on demand.  The manifest says which folders a month has, in one file, so a reader sees one whole
version, and neither reading nor an increment lists the layers that were written before.

Rows are brought together by month with a rebalancing exchange: AQE splits a large month into
several files and merges small ones, without sampling the plan first, and each file is sorted by
the clustering keys, so that its min / max statistics are narrow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators.incremental import matched, upsert
from pricelake.session import TASK_BYTES, small_tasks
from pricelake.sources import manifest
from pricelake.sources.manifest import Manifest
from pricelake.streaming.folders import list_folders

MONTH = "part_month"
#: Column -> its expression over the other columns.
Derived = dict[str, Column] | None
#: Folders of a month before it is folded.
FOLDERS = 8


def months_between(since: str, until: str) -> list[str]:
    """The months (yyyy-MM) of a range of dates, both included: the parts that a read needs."""
    y, m = int(since[:4]), int(since[5:7])
    out = []
    while f"{y:04d}-{m:02d}" <= until[:7]:
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def write(df: DataFrame, path: str, keys: list[str], date: str = "price_date", derived: Derived = None) -> list[str]:
    """Write ``df`` as a layer: folders by the month of ``date``, files sorted by ``keys``.  Returns the
    months.  Columns that are ``derived`` from others are not shuffled but computed where the rows are written."""
    more = derived or {}
    rows = (df.drop(*more).withColumn(MONTH, F.date_format(date, "yyyy-MM"))
            .hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, *keys))
    out = rows.select(*[more[c].alias(c) if c in more else F.col(c) for c in df.columns], MONTH)
    with small_tasks(df.sparkSession, 2 * TASK_BYTES):      # it is also the size of the files, before compression by column
        out.write.mode("overwrite").option("compression", "zstd").partitionBy(MONTH).parquet(path)
    return list_folders(df.sparkSession, path, f"{MONTH}=")


def publish(df: DataFrame, root: str, keys: list[str], date: str = "price_date", derived: Derived = None,
            **info) -> Manifest:
    """Full refresh: ``df`` is the table."""
    spark = df.sparkSession
    n = manifest.last(spark, root) + 1
    months = write(df, f"{root}/v={n}", keys, date, derived)
    return manifest.commit(spark, root, n, {m: [f"v={n}/{MONTH}={m}"] for m in months}, df.schema,
                           layer=f"v={n}", **info)


def merge(spark: SparkSession, table: Manifest, batch: DataFrame, key: str, keys: list[str],
          date: str = "price_date", folders: int = FOLDERS, derived: Derived = None,
          parts: list[str] | None = None, **info) -> Manifest:
    """Upsert a stored batch into the table.  ``key`` must determine the month (a row never moves to
    another one).  ``parts`` are columns that the key is the digest of, which must be among ``derived`` then.
    Of the months that the batch replaces rows in, only those that keep others are read whole."""
    month = F.date_format(date, "yyyy-MM")
    touched = [r[0] for r in batch.select(month).distinct().collect()]
    known = manifest.read(spark, table, touched)
    own = known.select(*(parts or [key]), month.alias(MONTH))           # reads the key and the date of these months
    found = reduce(DataFrame.union, [matched(own, batch, key, parts, how).select(MONTH, F.lit(how == "left_semi").alias("hit"))
                                     for how in ("left_semi", "left_anti")]).distinct().collect()
    replaced = {r[MONTH] for r in found if r["hit"]}
    mixed = sorted(replaced & {r[MONTH] for r in found if not r["hit"]})
    rows = batch.select(*known.columns)
    if mixed:
        rows = upsert(manifest.read(spark, table, mixed), rows, key, batch.filter(month.isin(mixed)), parts=parts,
                      derived=derived if parts else None)
    n = table.version + 1
    months = {**table.parts}
    for m in write(rows, f"{table.root}/d={n}", keys, date, derived):
        months[m] = [*([] if m in replaced else months.get(m, [])), f"d={n}/{MONTH}={m}"]
    out = manifest.commit(spark, table.root, n, months, known.schema, **{**table.info, "layer": f"d={n}", **info})
    return fold(spark, out, keys, date, folders, derived)


def fold(spark: SparkSession, table: Manifest, keys: list[str], date: str = "price_date", folders: int = 1,
         derived: Derived = None) -> Manifest:
    """Write the months of more than ``folders`` folders anew, each as one; a version of its own with the
    same rows."""
    long = [m for m, fs in table.parts.items() if len(fs) > folders]
    if not long:
        return table
    n = table.version + 1
    rows = manifest.read(spark, table, long)
    write(rows, f"{table.root}/c={n}", keys, date, derived)
    parts = {**table.parts, **{m: [f"c={n}/{MONTH}={m}"] for m in long}}
    return manifest.commit(spark, table.root, n, parts, rows.schema, **table.info)
