"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults that matter for the jobs in this package.  AQE re-plans joins at runtime: a side is
# broadcast only when its *measured* size is under the adaptive broadcast threshold, otherwise
# the sort-merge join stays; skewed shuffle partitions are split.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files (written before range-partitioned mart writes) are removed once the
    # checkpointed data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Compressed shuffle bytes of a task in the jobs that sort whole rows.  They are four to eight times as many in
# memory, so Spark's 64 MB make tasks that spill on executors of 1 GB a core, and leave the last wave of tasks
# short of cores; with this size a task holds some 100 MB, however large the table is.
TASK_BYTES = 16 * 1024 * 1024
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# Shuffle files of a job are removed at its end, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def small_tasks(spark: SparkSession, size: int = TASK_BYTES) -> Iterator[None]:
    """For jobs that write a table: they get shuffle tasks of ``size``, and their shuffle files are removed at
    their end.  What the session sets itself is kept."""
    own = {k: v for k, v in ((ADVISORY, str(size)), (CLEANUP, "true")) if spark.conf.get(k, None) is None}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in own:
            spark.conf.unset(k)


def get_spark(master: str | None = None, app: str = "pricelake",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a folder every executor can reach) and must be.
    Only in local mode, where there is one machine, a fresh folder under the system temp dir is
    created and set when it is not.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif (sc.master or "").startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="pricelake-ckpt-"))
    else:
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder (for written intermediates)."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
