"""Tables with a committed manifest: what belongs to a table is one small file, swapped at once.

A table is a folder.  Data are written beside what is there, in folders that no reader knows yet; a
version of the table is then committed by renaming one JSON file into ``_manifest/``.  It lists
the folders of each part of the table (one part, or a part per month), the schema and whatever
else belongs to the version.  The highest committed number is the table.  So a job that dies while
it writes leaves the table as it was, a reader that has read a manifest sees one whole version
whatever is committed meanwhile, and what a read costs does not depend on how many versions there
were: it opens one file and lists no folder but those it reads.

A table has one writer at a time; a second one that commits the same number fails.  ``vacuum``
removes what the last manifests no longer name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pricelake.streaming.folders import delete, exists, list_names, read_text, write_once

HOME = "_manifest"
#: Part of a table that has only one.
ALL = ""


@dataclass(frozen=True)
class Manifest:
    """A version of the table at ``root``: folders of each part (relative to the root, oldest first;
    a whole path is another table's, which this one was derived from)."""

    root: str
    version: int
    parts: dict[str, list[str]]
    schema: str
    info: dict = field(default_factory=dict)

    def folders(self, parts=None) -> list[str]:
        """The folders of all parts, or of those given."""
        wanted = None if parts is None else set(parts)
        return [f if "/" == f[0] or ":/" in f else f"{self.root}/{f}" for p, fs in sorted(self.parts.items()) if wanted is None or p in wanted for f in fs]


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed versions, ascending."""
    names = list_names(spark, f"{root}/{HOME}")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def last(spark: SparkSession, root: str) -> int:
    return max([0, *versions(spark, root)])


def at(spark: SparkSession, root: str, version: int) -> Manifest:
    return Manifest(root, **json.loads(read_text(spark, f"{root}/{HOME}/{version:08d}.json")))


def current(spark: SparkSession, root: str) -> Manifest | None:
    n = last(spark, root)
    return at(spark, root, n) if n else None


def commit(spark: SparkSession, root: str, version: int, parts: dict[str, list[str]], schema: T.StructType,
           **info) -> Manifest:
    """Make this the table.  Fails if the version is there already."""
    new = Manifest(root, version, parts, schema.json(), info)
    text = json.dumps({"version": version, "parts": parts, "schema": new.schema, "info": info})
    write_once(spark, f"{root}/{HOME}/{version:08d}.json", text, f"{root}/{HOME}/.{uuid.uuid4().hex}")
    return new


def read(spark: SparkSession, table: Manifest, parts=None) -> DataFrame:
    """The rows of a version, or of some of its parts."""
    schema = T.StructType.fromJson(json.loads(table.schema))
    folders = table.folders(parts)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def write_version(df: DataFrame, root: str, write: Callable[[DataFrame, str], None] | None = None) -> int:
    """Write ``df`` as the data of the next version of the table, which is not committed yet."""
    n = last(df.sparkSession, root) + 1
    (write or (lambda d, path: d.write.mode("overwrite").option("compression", "zstd").parquet(path)))(df, f"{root}/v={n}")
    return n


def commit_version(df: DataFrame, root: str, n: int, **info) -> Manifest:
    """Commit what ``write_version`` has written."""
    return commit(df.sparkSession, root, n, {ALL: [f"v={n}"]}, df.schema, layer=f"v={n}", **info)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the data and manifests that none of the last ``keep`` versions needs; returns their
    folders.  Readers of older versions must be done."""
    found = versions(spark, root)
    kept = {f.split("/")[0] for n in found[-keep:] for f in (x for fs in at(spark, root, n).parts.values() for x in fs)}
    gone = [d for d in list_names(spark, root) if d[:2] in ("v=", "d=", "c=") and d[2:].isdigit()
            and d not in kept and int(d[2:]) <= max(found, default=0)]
    for n in found[:-keep]:
        delete(spark, f"{root}/{HOME}/{n:08d}.json")
    for d in gone:
        delete(spark, f"{root}/{d}")
    return [f"{root}/{d}" for d in gone]


def table_exists(spark: SparkSession, root: str) -> bool:
    return exists(spark, f"{root}/{HOME}") and last(spark, root) > 0
