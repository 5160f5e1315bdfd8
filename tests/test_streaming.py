"""File-arrival incremental build: each run processes only new files; late files still land."""

from pyspark.sql import functions as F

from pricelake.operators import marts, staging
from pricelake.plans import catalog
from pricelake.plans.warehouse import Warehouse
from pricelake.session import scratch_path
from pricelake.sources import manifest
from pricelake.streaming import file_stream
from pricelake.streaming.folders import list_versions

SF = "/root/testdata/sf0.001"


def test_late_arrival_is_picked_up(spark):
    work = scratch_path(spark, "stream-test")
    raw_dir = f"{work}/raw"
    prices = Warehouse.of(spark, SF).stage("raw_stock_prices")     # text, as files arrive
    companies = catalog.stg_c(spark, SF)
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    # The newer rows arrive first, the older ones later: a max(ingested_at) watermark would
    # skip the second arrival; the stream tracks files and loads it.
    prices.filter(F.col("ingested_at") > cut).write.parquet(f"{raw_dir}/arrival=1")
    first = file_stream.run_available(spark, raw_dir, companies, work)
    n_first = first.count()
    prices.filter(F.col("ingested_at") <= cut).write.parquet(f"{raw_dir}/arrival=2")
    second = file_stream.run_available(spark, raw_dir, companies, work)
    full = marts.fct_prices(staging.stg_prices(prices), companies)
    cols = [c for c in full.columns if c != "dbt_updated_at"]
    assert second.count() == full.count() > n_first
    assert second.select(cols).exceptAll(full.select(cols)).count() == 0
    # A run with no new files writes no new version.
    versions = manifest.versions(spark, f"{work}/target")
    file_stream.run_available(spark, raw_dir, companies, work)
    assert manifest.versions(spark, f"{work}/target") == versions and len(versions) >= 2
    again = file_stream.rebuild(spark, f"{work}/history", f"{work}/rebuilt", companies)
    assert again.count() == full.count() and again.select(cols).exceptAll(full.select(cols)).count() == 0


def test_replayed_epoch_is_idempotent(spark):
    """foreachBatch may run an epoch again after a failure: the same epoch id rewrites the same
    history and target folders, so the published result does not change."""
    work = scratch_path(spark, "stream-replay")
    prices = Warehouse.of(spark, SF).stage("raw_stock_prices")
    companies = catalog.stg_c(spark, SF)
    batch = prices.filter(F.col("ingested_at") <= F.lit("1997-01-01").cast("timestamp_ntz"))
    args = (f"{work}/history", f"{work}/target", companies)
    file_stream.process_batch(spark, batch, 0, *args)
    now = lambda: sorted(map(tuple, file_stream.latest(spark, args[1]).drop("dbt_updated_at").collect()))
    first = now()
    file_stream.process_batch(spark, batch, 0, *args)              # replay
    assert first == now() and len(first) > 0
    later = prices.filter((F.col("ingested_at") > F.lit("1997-01-01").cast("timestamp_ntz"))
                          & (F.col("ingested_at") <= F.lit("1997-03-01").cast("timestamp_ntz")))
    file_stream.process_batch(spark, later, 1, *args)
    second = now()
    file_stream.process_batch(spark, later, 1, *args)              # replay of an increment
    assert second == now() and len(second) > len(first)
    assert list_versions(spark, f"{work}/history", "epoch=") == [0, 1]


def test_bars_delivered_again_are_one_row(spark):
    work = scratch_path(spark, "stream-again")
    prices = Warehouse.of(spark, SF).stage("raw_stock_prices")
    companies = catalog.stg_c(spark, SF)
    args = (f"{work}/history", f"{work}/target", companies)
    batch = prices.filter(F.col("ingested_at") <= F.lit("1996-01-01").cast("timestamp_ntz"))
    file_stream.process_batch(spark, batch, 0, *args)
    first = file_stream.latest(spark, args[1]).drop("dbt_updated_at").collect()
    file_stream.process_batch(spark, batch, 1, *args)              # the same bars, as a new epoch
    again = file_stream.latest(spark, args[1]).drop("dbt_updated_at").collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again)) and len(first) > 0


def test_history_is_one_scan_and_read_by_bucket(spark):
    """The plan over the history does not grow with its epochs, and a ticker opens its bucket only."""
    work = scratch_path(spark, "stream-history")
    prices = Warehouse.of(spark, SF).stage("raw_stock_prices")
    tickers = sorted(r[0] for r in prices.select(F.upper(F.trim("ticker"))).distinct().collect())
    plans = []
    for epoch in range(3):
        part = prices.filter(F.year(F.to_date("date")) == 1995 + epoch)
        back = file_stream.add_to_history(part, epoch, f"{work}/history")
        assert back.count() == part.count()
        text = file_stream.history(spark, f"{work}/history", tickers[:1])._jdf.queryExecution().optimizedPlan().toString()
        plans.append(text.count("\n"))
    assert len(set(plans)) == 1
    everything, own = file_stream.history(spark, f"{work}/history"), file_stream.history(spark, f"{work}/history", [tickers[0].lower()])
    want = prices.filter((F.upper(F.trim("ticker")) == tickers[0]) & F.year(F.to_date("date")).between(1995, 1997))
    assert own.select("date", "close").exceptAll(want.select("date", "close")).count() == 0 and own.count() == want.count()
    paths = {r[0] for r in own.select(F.input_file_name()).distinct().collect()}
    assert len({p.split("bucket=")[1].split("/")[0] for p in paths}) == 1
    scan = own._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "bucket" in scan.split("PartitionFilters")[1].split("]")[0]
    assert everything.select("epoch").distinct().count() == 3
