"""Raw inputs derived by Spark from the driver's TPC-H-like tables.

The reference loads daily bars and company records that were downloaded from the internet; here
the same raw shapes are *derived* from the given parquet tables, so every job's work grows with
the input scale:

* ``raw_prices``    one bar per supplier per ship date (prices in cents, as strings, with dirt)
* ``raw_companies`` supplier x nation x region, with duplicate records per ticker
* ``event_bars``    one bar per user per event day (a second extract with intraday movement)
* ``job_log`` / ``metering``  query-log and credit-metering rows from ``events``

Aggregations run before joins, and only the columns needed are read from each scan.  There is hardly
more than one line per bar, so combining lines before the shuffle would sort every scan split to save
almost no row: the narrow lines are dealt by key and year and sorted once (``_by_year``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Fixed values of the fixture mapping.
DIRT_MODULUS = 50          # (suppkey * 31 + days since 1995-01-01) % 50 selects dirty bars
DIRT_EPOCH = "1995-01-01"
COMPANY_LOADED_AT = "2024-01-01 00:00:00"
COMPANY_RELOADED_AT = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money(c) -> F.Column:
    return c.cast("decimal(18,2)").cast("string")


def _by_year(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt by key and year of ``d`` (added as ``y``): bars grouped by (key, y, d) need no other shuffle,
    and a key's bars of a year leave a task together and in order, so what is written or shuffled after
    them compresses well."""
    return rows.withColumn("y", F.year("d")).repartition(key, "y")


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean OHLCV bars per (supplier, ship date) before names and dirt are applied."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        F.col("l_shipdate").cast("date").alias("d"))
    tie = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    # The price is part of the order, so the first and last row need no column of their own.
    return _by_year(li, "l_suppkey").groupBy("l_suppkey", "y", "d").agg(
        F.min(tie)["l_extendedprice"].alias("o"),
        F.max("l_extendedprice").alias("h"),
        F.min("l_extendedprice").alias("l"),
        F.max(tie)["l_extendedprice"].alias("c"),
        F.sum("l_quantity").cast("bigint").alias("v"),
    ).drop("y")


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW price rows: all fields are text as in a CSV stage; some bars are deliberately bad."""
    bars = supplier_bars(spark, sf_dir)
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    k = bars.join(sup, bars.l_suppkey == sup.s_suppkey).withColumn(
        "m", (F.col("l_suppkey") * 31 + F.datediff("d", F.lit(DIRT_EPOCH))) % DIRT_MODULUS)
    return k.select(
        F.col("d").cast("string").alias("date"),
        F.when(F.col("m") == 1, F.lit("0")).otherwise(_money(F.col("o"))).alias("open"),
        _money(F.when(F.col("m") == 2, F.col("l") - 1).otherwise(F.col("h"))).alias("high"),
        _money(F.col("l")).alias("low"),
        F.when(F.col("m") == 3, F.lit("n/a")).otherwise(_money(F.col("c"))).alias("close"),
        F.col("v").cast("string").alias("volume"),
        F.concat(F.lit("  "), F.lower("s_name"), F.lit(" ")).alias("ticker"),
        (F.col("d").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")).alias("ingested_at"),
    )


def raw_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW company rows; every third supplier has a second, later and poorer record."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    a = (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
         .join(reg, nat.n_regionkey == reg.r_regionkey)
         .withColumn("cap", F.round(F.col("s_acctbal") * 100).cast("bigint") * 1000000))
    first = a.select(
        F.concat(F.lit(" "), F.lower("s_name")).alias("ticker"),
        F.concat("s_name", F.lit(" Inc ")).alias("company_name"),
        F.lower("r_name").alias("sector"),
        F.concat(F.lower("r_name"), F.lit("/"), F.lower("n_name")).alias("industry"),
        F.lower("n_name").alias("country"),
        F.lit("nyq").alias("exchange"),
        F.lit("usd").alias("currency"),
        F.col("cap").alias("market_cap"),
        (F.col("s_suppkey") * 10).alias("full_time_employees"),
        F.when(F.col("s_suppkey") % 5 == 0, F.lit(" "))
         .otherwise(F.concat(F.lit("https://"), F.lower("s_name"), F.lit(".example")))
         .alias("website"),
        F.lit(COMPANY_LOADED_AT).cast("timestamp_ntz").alias("ingested_at"),
    )
    second = a.filter(F.col("s_suppkey") % 3 == 0).select(
        F.lower("s_name").alias("ticker"),
        F.concat("s_name", F.lit(" Old")).alias("company_name"),
        F.lower("r_name").alias("sector"),
        F.lower("r_name").alias("industry"),
        F.lower("n_name").alias("country"),
        F.lit("nyq").alias("exchange"),
        F.lit("usd").alias("currency"),
        F.when(F.col("s_suppkey") % 2 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("cap") - 1).alias("market_cap"),
        F.lit(None).cast("bigint").alias("full_time_employees"),
        F.lit(None).cast("string").alias("website"),
        F.lit(COMPANY_RELOADED_AT).cast("timestamp_ntz").alias("ingested_at"),
    )
    return first.unionByName(second)


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second RAW price extract: one bar per user per event day, ticker ``USER_<id>``."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "value", F.col("ts").cast("date").alias("d"))
    tie = F.struct("ts", "event_id")
    b = _by_year(ev, "user_id").groupBy("user_id", "y", "d").agg(
        F.min_by("value", tie).alias("o"), F.max("value").alias("h"),
        F.min("value").alias("l"), F.max_by("value", tie).alias("c"),
        F.count(F.lit(1)).alias("v"))
    return b.select(
        F.col("d").cast("string").alias("date"),
        _money(F.col("o")).alias("open"),
        _money(F.col("h")).alias("high"),
        _money(F.col("l")).alias("low"),
        _money(F.col("c")).alias("close"),
        F.col("v").cast("string").alias("volume"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("ticker"),
        (F.col("d").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")).alias("ingested_at"),
    )


def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query-history rows (one per event)."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return ev.select(
        F.col("event_id").alias("query_id"),
        F.concat(F.when(F.col("event_id") % 3 == 0, F.lit("MERGE INTO ")).otherwise(F.lit("SELECT * FROM ")),
                 F.when(F.col("user_id") % 2 == 0, F.lit("fct_stock_prices")).otherwise(F.lit("other")))
         .alias("query_text"),
        F.lit("ANALYTICS").alias("database_name"),
        F.upper("event_type").alias("schema_name"),
        F.when(F.col("event_id") % 3 == 0, F.lit("MERGE")).otherwise(F.lit("SELECT")).alias("query_type"),
        F.concat(F.lit("WH_"), (F.col("user_id") % 4).cast("string")).alias("warehouse_name"),
        F.when(F.col("event_type") == "error", F.lit("FAIL")).otherwise(F.lit("SUCCESS"))
         .alias("execution_status"),
        F.col("ts").alias("start_time"),
        F.timestamp_add("MILLISECOND", F.round(F.col("value") * 1000).cast("bigint"),
                        F.col("ts"))
         .alias("end_time"),
        (F.col("value") * 1000).alias("total_elapsed_time"),
        (k * 1048576).alias("bytes_scanned"),
        F.when(k % 5 == 0, k * 65536).otherwise(F.lit(0)).alias("bytes_spilled_to_local_storage"),
        (k % 10).alias("partitions_scanned"),
        F.when(k % 7 == 0, F.lit(0)).otherwise(F.lit(10)).alias("partitions_total"),
        (F.col("value") * 0.001).alias("credits_used_cloud_services"),
    )


def metering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse credit-metering rows; decimals keep the hourly sums exact."""
    ev = table(spark, sf_dir, "events")
    used = F.col("value").cast("decimal(18,2)")
    compute = (used * F.lit(0.75).cast("decimal(3,2)")).cast("decimal(20,4)")
    return ev.select(
        F.col("ts").alias("start_time"),
        used.cast("decimal(20,4)").alias("credits_used"),
        compute.alias("credits_used_compute"),
        (used.cast("decimal(20,4)") - compute).alias("credits_used_cloud_services"),
        F.concat(F.lit("WH_"), (F.col("user_id") % 4).cast("string")).alias("warehouse_name"),
    )
