import datetime as dt

from pricelake.operators import joblog
from pricelake.session import scratch_path
from pricelake.sources import files

LOG = ("query_id long, query_text string, database_name string, schema_name string, "
       "query_type string, warehouse_name string, execution_status string, "
       "start_time timestamp_ntz, end_time timestamp_ntz, total_elapsed_time double, "
       "bytes_scanned long, bytes_spilled_to_local_storage long, partitions_scanned long, "
       "partitions_total long, credits_used_cloud_services double")


def log(spark):
    t = dt.datetime(2024, 1, 30)
    old = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([
        (1, "MERGE INTO fct_stock_prices", "D", "S", "MERGE", "WH", "SUCCESS", t, t, 2000.0, 1048576, 0, 5, 10, 0.1),
        (2, "select * from fct_stock_prices", "D", "S", "SELECT", "WH", "SUCCESS", t, t, 3000.0, 2097152, 0, 0, 0, 0.1),
        (3, "select * from fct_stock_prices", "D", "S", "SELECT", "WH", "FAIL", t, t, 9000.0, 1, 0, 0, 0, 0.1),
        (4, "select 1", "D", "S", "SELECT", "WH", "SUCCESS", old, old, 9999.0, 1, 0, 0, 0, 0.1),
        (5, "select 1", "D", "S", "SELECT", "OTHER", "SUCCESS", t, t, 3000.0, 1, 0, 0, 0, 0.1),
    ], LOG)


def test_refresh_comparison(spark):
    out = {r["run_type"]: r for r in joblog.refresh_comparison(log(spark), "2024-01-31", "WH").collect()}
    assert out["Incremental Run"]["total_queries"] == 1
    assert out["Incremental Run"]["avg_pruning_pct"] == 50.0
    assert out["Full Refresh Run"]["avg_execution_secs"] == 3.0
    assert out["Full Refresh Run"]["avg_pruning_pct"] is None      # nullif(total, 0)


def test_slowest_and_recent(spark):
    s = joblog.slowest(log(spark), "2024-01-31", "WH", n=1).collect()
    assert s[0]["query_id"] == 2 and s[0]["execution_time_secs"] == 3.0
    r = joblog.recent_queries(log(spark), "2024-01-31", "WH").collect()
    assert sorted(x["query_id"] for x in r) == [1, 2]


def test_layout_report_on_written_table(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=i), f"T{i % 3}")
                                for i in range(300)], "price_date date, ticker string")
    good = scratch_path(spark, "layout-good")
    files.write_clustered(df, good, ["price_date", "ticker"], partitions=4)
    rep = joblog.layout_report(spark, [good], ["price_date", "ticker"]).collect()[0]
    assert rep["total_rows"] == 300 and rep["total_units"] == 4
    assert (rep["average_depth"], rep["max_depth"], rep["average_overlaps"]) == (1.0, 1, 0.0)
    bad = scratch_path(spark, "layout-bad")
    df.repartition(4, "ticker").write.parquet(bad)
    rep2 = joblog.layout_report(spark, [bad], ["price_date", "ticker"]).collect()[0]
    assert rep2["max_depth"] == rep2["total_units"] > 1    # every file spans the whole date range


def test_clustering_depth_by_hand(spark):
    """Text keys: [a, c], [b, d], [d, e], [x, y] and a single point x: pairs overlap 1-2, 2-3, 4-5."""
    r = spark.createDataFrame([("1", 1, ("a",), ("c",)), ("2", 1, ("b",), ("d",)), ("3", 2, ("d",), ("e",)),
                               ("4", 3, ("x",), ("y",)), ("5", 1, ("x",), ("x",))],
                              "unit string, rows long, lo struct<k:string>, hi struct<k:string>")
    got = joblog.clustering_depth(r, ["k"]).collect()[0]
    assert (got["total_units"], got["total_rows"], got["max_depth"]) == (5, 8, 2)
    assert got["average_overlaps"] == 1.2 and got["average_depth"] == 1.6
    none = joblog.clustering_depth(r.limit(0), ["k"]).collect()[0]
    assert none["total_units"] == 0 and none["average_depth"] is None


def test_hourly_usage_sums(spark):
    from decimal import Decimal
    m = spark.createDataFrame([
        (dt.datetime(2024, 1, 30, 10, 5), Decimal("1.25"), Decimal("1.00"), Decimal("0.25"), "WH"),
        (dt.datetime(2024, 1, 30, 10, 55), Decimal("2.50"), Decimal("2.00"), Decimal("0.50"), "WH"),
        (dt.datetime(2024, 1, 30, 11, 0), Decimal("1.00"), Decimal("1.00"), Decimal("0.00"), "WH"),
        (dt.datetime(2024, 1, 30, 11, 0), Decimal("9.00"), Decimal("9.00"), Decimal("0.00"), "X"),
        (dt.datetime(2024, 1, 1, 11, 0), Decimal("9.00"), Decimal("9.00"), Decimal("0.00"), "WH"),
    ], "start_time timestamp_ntz, credits_used decimal(20,4), credits_used_compute decimal(20,4), "
       "credits_used_cloud_services decimal(20,4), warehouse_name string")
    out = joblog.hourly_usage(m, "2024-01-31", "WH").collect()
    assert [(r["hour"].hour, r["credits_used"], r["cloud_service_credits"]) for r in out] == [
        (11, 1.0, 0.0), (10, 3.75, 0.75)]
