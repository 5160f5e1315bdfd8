"""Helpers shared by the operators: table access, shared-folder tables, names that cannot clash."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

import pricelake
from pricelake.session import scratch_path

_shipped: set[str] = set()
#: Rows of an Arrow batch; Spark's own number lets a batch of texts grow to 64 MB on either side.
BATCH, BATCH_KEY = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: their Python workers need not
    share the driver's import path.  Also sets the session to short Arrow batches, unless it has
    its own number."""
    sc = spark.sparkContext
    if spark.conf.get(BATCH_KEY) == "10000":
        spark.conf.set(BATCH_KEY, str(BATCH))
    if sc.applicationId not in _shipped:
        home = os.path.dirname(os.path.abspath(pricelake.__file__))
        name = os.path.join(tempfile.mkdtemp(prefix="pricelake-"), "pricelake-code")
        sc.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(home), os.path.basename(home)))
        _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost
    executors, and gives later joins plain exchanges that AQE can split when they are skewed."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def bucket_of(column: str, modulus: int) -> str:
    """SQL text of ``crc32(column as text) mod modulus`` (null when the column is null)."""
    return f"crc32(cast(cast({column} as string) as binary)) % {modulus}"
