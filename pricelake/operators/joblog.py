"""Job-log analyses: recent queries, refresh comparison, hourly credits, slowest queries, and
storage reports over written tables (layout / clustering depth, table inventory)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelake.functions.scalar import exact_avg, run_type

# Fixed values of the analyses.
LOOKBACK_DAYS = 7
RECENT_LIMIT = 100
SLOWEST_LIMIT = 10
PREVIEW_CHARS = 100
MODEL_TEXT_MARKERS = ["%fct_stock_prices%", "%int_stock_moving_averages%"]
MB = 1024 * 1024


def _as_of(as_of) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")


def recent(log: DataFrame, as_of=None, days: int = LOOKBACK_DAYS, warehouse: str | None = None,
           status: str | None = "SUCCESS") -> DataFrame:
    """Rows started within ``days`` before ``as_of``, optionally for one warehouse / status."""
    out = log.filter(F.col("start_time") >= _as_of(as_of) - F.expr(f"INTERVAL {days} DAYS"))
    if warehouse is not None:
        out = out.filter(F.col("warehouse_name") == warehouse)
    if status is not None:
        out = out.filter(F.col("execution_status") == status)
    return out


def seconds(c="total_elapsed_time") -> Column:
    return F.round(F.col(c) / 1000, 2)


def megabytes(c) -> Column:
    return F.round(F.col(c) / 1024 / 1024, 2)


def pruning_pct() -> Column:
    return F.round((1 - F.col("partitions_scanned")
                    / F.nullif(F.col("partitions_total"), F.lit(0))) * 100, 2)


def recent_queries(log: DataFrame, as_of=None, warehouse: str | None = None,
                   n: int = RECENT_LIMIT) -> DataFrame:
    """The newest ``n`` successful queries with seconds, MB scanned / spilled and pruning %."""
    r = recent(log, as_of, warehouse=warehouse)
    return (r.select(
        "query_id", "query_text", "database_name", "schema_name", "query_type", "warehouse_name",
        "execution_status", "start_time", "end_time",
        seconds().alias("execution_time_secs"),
        megabytes("bytes_scanned").alias("mb_scanned"),
        megabytes("bytes_spilled_to_local_storage").alias("mb_spilled_to_disk"),
        "partitions_scanned", "partitions_total",
        pruning_pct().alias("partition_pruning_pct"),
        "credits_used_cloud_services")
        .orderBy(F.col("start_time").desc(), F.col("query_id").desc()).limit(n))


def refresh_comparison(log: DataFrame, as_of=None, warehouse: str | None = None) -> DataFrame:
    """Model-related queries tagged incremental vs full refresh: count and rounded means."""
    t = F.lower("query_text")
    r = recent(log, as_of, warehouse=warehouse).filter(
        reduce(lambda a, b: a | b, [t.like(p) for p in MODEL_TEXT_MARKERS]))
    tagged = r.select(
        run_type("query_text").alias("run_type"),
        seconds().alias("execution_time_secs"),
        megabytes("bytes_scanned").alias("mb_scanned"),
        pruning_pct().alias("partition_pruning_pct"))
    return (tagged.groupBy("run_type").agg(
        F.count(F.lit(1)).alias("total_queries"),
        exact_avg("execution_time_secs", 2, 2).alias("avg_execution_secs"),
        exact_avg("mb_scanned", 2, 2).alias("avg_mb_scanned"),
        exact_avg("partition_pruning_pct", 2, 2).alias("avg_pruning_pct"))
        .orderBy("run_type"))


def hourly_usage(metering: DataFrame, as_of=None, warehouse: str | None = None) -> DataFrame:
    """Credits per hour (sums are exact decimals, published as DOUBLE)."""
    r = recent(metering, as_of, warehouse=warehouse, status=None)
    return (r.groupBy(F.date_trunc("hour", "start_time").alias("hour")).agg(
        F.sum("credits_used").cast("double").alias("credits_used"),
        F.sum("credits_used_compute").cast("double").alias("compute_credits"),
        F.sum("credits_used_cloud_services").cast("double").alias("cloud_service_credits"))
        .orderBy(F.col("hour").desc()))


def slowest(log: DataFrame, as_of=None, warehouse: str | None = None,
            n: int = SLOWEST_LIMIT) -> DataFrame:
    """Top ``n`` by the raw (unrounded, unprojected) elapsed time; ties by query id."""
    r = recent(log, as_of, warehouse=warehouse)
    top = r.orderBy(F.col("total_elapsed_time").desc(), F.col("query_id").asc()).limit(n)
    return top.select(
        "query_id",
        F.left("query_text", F.lit(PREVIEW_CHARS)).alias("query_preview"),
        seconds().alias("execution_time_secs"),
        megabytes("bytes_scanned").alias("mb_scanned"),
        "partitions_scanned", "partitions_total",
        pruning_pct().alias("partition_pruning_pct"))


# --------------------------------------------------------------------------------------------
# Storage reports over written parquet
# --------------------------------------------------------------------------------------------
#: Folder of a row's file, to measure the folders of a partitioned table.
FOLDER = "regexp_replace(_metadata.file_path, '/[^/]*$', '')"


def file_ranges(df: DataFrame, keys: list[str], unit: str = "_metadata.file_path") -> DataFrame:
    """Per file (or other ``unit``, an expression): rows, and the smallest and greatest clustering key (``lo`` / ``hi``, of all its
    columns).  A distributed group-by."""
    key = F.struct(*keys)
    return df.groupBy(F.expr(unit).alias("unit")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("lo"), F.max(key).alias("hi"))


def clustering_depth(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Clustering summary from per-file key ranges, of any types, by a sweep: a range opens at its
    start and closes after its end, and the running sum is the number of ranges open.

    ``average_depth`` / ``max_depth``: ranges open where a file's range begins, itself included;
    ``average_overlaps``: other files that a file's range overlaps (every overlapping pair is met
    once, where the later one begins).  1 and 0 are perfect.  The sweep is one ordered window over
    two rows per file."""
    events = ranges.select(
        "unit", F.explode(F.array(F.struct(F.col("lo").alias("at"), F.lit(1).alias("step"), F.col("rows")),
                                  F.struct(F.col("hi").alias("at"), F.lit(-1).alias("step"), F.col("rows")))).alias("e"))
    w = Window.orderBy("e.at", F.col("e.step").desc(), "unit").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    starts = events.withColumn("depth", F.sum("e.step").over(w)).filter("e.step = 1")
    n, d = F.count(F.lit(1)), F.sum("depth")
    return starts.agg(
        F.lit(", ".join(keys)).alias("clustering_key"), n.alias("total_units"),
        F.coalesce(F.sum("e.rows"), F.lit(0)).alias("total_rows"), F.max("depth").alias("max_depth"),
        F.round(F.try_divide(d, n), 4).alias("average_depth"),
        F.round(F.try_divide((d - n) * 2, n), 4).alias("average_overlaps"))


def layout_report(spark: SparkSession, folders: list[str], keys: list[str],
                  unit: str = "_metadata.file_path") -> DataFrame:
    """Clustering effectiveness of written parquet folders on the whole clustering key, by file or by another
    ``unit``, such as ``FOLDER``."""
    return clustering_depth(file_ranges(spark.read.parquet(*folders), keys, unit), keys)


def table_inventory(spark: SparkSession,
                    tables: list[tuple[str, str, list[str] | None]]) -> DataFrame:
    """Rows, size in MB and last modification per (layer, table, folders), sorted by layer, table;
    a view (no folders) has nulls.

    Row counts come from a scan that reads no data columns (``_metadata`` only); sizes are
    summed over distinct files."""
    parts = []
    for layer, name, folders in tables:
        label = [F.lit(layer).alias("table_schema"), F.lit(name).alias("table_name")]
        if not folders:
            none = [F.lit(None).cast(t).alias(c) for c, t in
                    (("row_count", "bigint"), ("size_mb", "double"), ("last_altered", "timestamp"))]
            parts.append(spark.range(1).select(*label, *none))
            continue
        m = spark.read.parquet(*folders).select(
            F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("sz"),
            F.col("_metadata.file_modification_time").alias("mt"))
        per_file = m.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.max("sz").alias("sz"),
                                      F.max("mt").alias("mt"))
        parts.append(per_file.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.coalesce(F.round(F.sum("sz") / MB, 2), F.lit(0.0)).alias("size_mb"),
            F.max("mt").alias("last_altered")).select(*label, "row_count", "size_mb", "last_altered"))
    return reduce(DataFrame.unionByName, parts).orderBy("table_schema", "table_name")
