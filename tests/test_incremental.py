import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricelake.operators import incremental, marts, staging
from pricelake.plans import catalog


def test_upsert_replace_insert_keep(spark):
    target = spark.createDataFrame([("k1", 1), ("k2", 2)], "k string, v int")
    batch = spark.createDataFrame([("k1", 10), ("k3", 30)], "k string, v int")
    got = sorted(tuple(r) for r in incremental.upsert(target, batch, "k").collect())
    assert got == [("k1", 10), ("k2", 2), ("k3", 30)]
    assert sorted(tuple(r) for r in incremental.upsert(None, batch, "k").collect()) == [
        ("k1", 10), ("k3", 30)]


def test_watermark_edges(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    target = spark.createDataFrame([("a", t(5))], "k string, ingested_at timestamp_ntz")
    src = spark.createDataFrame([("eq", t(5)), ("old", t(4)), ("new", t(6))],
                                "k string, ingested_at timestamp_ntz")
    assert [r["k"] for r in incremental.new_rows(src, target).collect()] == ["new"]
    empty = target.filter(F.lit(False))
    assert incremental.new_rows(src, empty).count() == 3        # empty target: first load
    assert incremental.new_rows(src, None).count() == 3


def test_initial_plus_increment_equals_full_rebuild(spark):
    sf = "/root/testdata/sf0.001"
    stg_p, stg_c = catalog.stg_p(spark, sf), catalog.stg_c(spark, sf)
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    target = marts.fct_prices(stg_p.filter(F.col("ingested_at") <= cut), stg_c)
    target = spark.createDataFrame(target.collect(), target.schema)   # a materialised table
    inc = incremental.fct_incremental(stg_p, stg_c, target).drop("dbt_updated_at")
    full = marts.fct_prices(stg_p, stg_c).drop("dbt_updated_at")
    assert inc.count() == full.count()
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0
    # The increment holds only rows newer than the target's watermark.
    batch, _ = incremental.fct_increment(stg_p, stg_c, target)
    hwm = target.agg(F.max("ingested_at")).collect()[0][0]
    assert batch.filter(F.col("ingested_at") <= hwm).count() == 0


def test_duplicate_keys_are_resolved(spark):
    b = spark.createDataFrame([("k", 1, 5), ("k", 2, 3), ("k", 2, 4), ("k", None, 9), ("j", None, 1)],
                              "k string, at int, v int")
    got = sorted(tuple(r) for r in incremental.latest_per_key(b, "k", ["at"]).collect())
    assert got == [("j", None, 1), ("k", 2, 4)]


def test_increment_from_state_equals_full_rebuild(spark):
    """Day by day from the stored state; then a late, a corrected and a re-delivered bar, which take
    the way through the ticker's history."""
    from pricelake.operators import series
    sf = "/root/testdata/sf0.001"
    stg_p, stg_c = catalog.stg_p(spark, sf).cache(), catalog.stg_c(spark, sf)
    cols = [c for c in marts.FCT_COLUMNS if c != "dbt_updated_at"]
    full = marts.fct_prices(stg_p, stg_c).select(cols).cache()
    kept = lambda df: spark.createDataFrame(df.collect(), df.schema)
    cut = F.lit("1997-06-01 00:00:00").cast("timestamp_ntz")
    early = stg_p.filter(F.col("ingested_at") <= cut)
    batch, state = incremental.fct_increment(early, stg_c, None)
    target, state = kept(batch), kept(state)
    for until in ("1997-06-05 00:00:00", "1997-09-01 00:00:00", "2100-01-01 00:00:00"):
        arrived = stg_p.filter(F.col("ingested_at") <= F.lit(until).cast("timestamp_ntz"))
        batch, after = incremental.fct_increment(arrived, stg_c, target, state)
        batch, state = kept(batch), kept(after)
        target = kept(incremental.upsert(target, batch, marts.FCT_KEY))
    assert target.count() == full.count()
    assert target.select(cols).exceptAll(full).count() == 0
    # the state is what a scan of the whole history gives
    by_chunk = lambda df: {(r["ticker"], r["_chunk"]): r for r in df.collect()}
    assert by_chunk(state.select(*series.series_state(stg_p).columns)) == by_chunk(series.series_state(stg_p))
    # corrections: older dates with a new load time
    day = F.dayofmonth("price_date")
    new_load = F.lit("2100-06-01 00:00:00").cast("timestamp_ntz")
    fixed = (stg_p.filter((day == 7) & (F.col("ticker") < "SUPPLIER#000000005"))
             .withColumns({"close_price": F.col("close_price") + 0.25, "ingested_at": new_load}))
    arrived = stg_p.unionByName(fixed).unionByName(fixed)
    batch, after = incremental.fct_increment(arrived, stg_c, target, state, backfill=True)
    target = incremental.upsert(target, batch, marts.FCT_KEY)
    latest = incremental.latest_per_key(arrived, marts.FCT_KEY, ["ingested_at"])
    again = marts.fct_prices(latest, stg_c).select(cols)
    assert target.count() == again.count() and target.select(cols).exceptAll(again).count() == 0
    assert by_chunk(after.select(*series.series_state(latest).columns)) == by_chunk(series.series_state(latest))


def test_build_full_then_incremental_versions(spark):
    """land RAW (early rows) -> full build v=1 -> land all rows -> incremental layer d=2; both
    layers together equal a full rebuild, v=1 is left as it was and d=2 holds only the months of
    the new rows; the quality summary runs."""
    from pricelake.plans import warehouse
    from pricelake.session import scratch_path
    from pricelake.sources import driver_tables as D
    from pricelake.sources import files

    sf = "/root/testdata/sf0.001"
    root = scratch_path(spark, "build-test")
    from pricelake.streaming.folders import list_folders
    raw_path = files.layer_path(root, warehouse.RAW, "raw_stock_prices")
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    warehouse.land_raw(spark, sf, root, ["raw_company_metadata"])
    files.full_refresh(D.raw_prices(spark, sf).filter(F.col("ingested_at") <= cut), raw_path)
    v1 = warehouse.build(spark, root, full_refresh=True)
    n1 = spark.read.parquet(v1["fct_stock_prices"]).count()
    files.full_refresh(D.raw_prices(spark, sf), raw_path)          # the next daily load
    v2 = warehouse.build(spark, root, full_refresh=False)
    assert v2["fct_stock_prices"].endswith("d=2") and v1["fct_stock_prices"].endswith("v=1")
    months = list_folders(spark, v2["fct_stock_prices"], "part_month=")
    assert min(months) == "1998-01" < max(months)
    inc = warehouse.current(spark, root, "fct_stock_prices").drop("dbt_updated_at")
    full = marts.fct_prices(catalog.stg_p(spark, sf), catalog.stg_c(spark, sf)).drop("dbt_updated_at")
    assert inc.count() == full.count() > n1 == spark.read.parquet(v1["fct_stock_prices"]).count()
    assert inc.exceptAll(full).count() == 0
    assert warehouse.run_tests(spark, root, as_of="2024-01-31").count() > 0


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.integers(0, 30), st.integers(0, 9), max_size=12),
       st.dictionaries(st.integers(0, 30), st.integers(10, 19), max_size=12))
def test_upsert_matches_dict_merge(spark, target, batch):
    """upsert == {**target, **batch} for any key sets (replace, insert, keep; never delete)."""
    t = spark.createDataFrame(list(target.items()), "k int, v int")
    b = spark.createDataFrame(list(batch.items()), "k int, v int")
    got = {r["k"]: r["v"] for r in incremental.upsert(t, b, "k").collect()}
    assert got == {**target, **batch}


def test_backfill_option_repairs_later_windows(spark):
    """Rows newer than the watermark but dated earlier than published rows: the reference's
    merge keeps stale windows on the later rows; backfill=True republishes them."""
    sf = "/root/testdata/sf0.001"
    stg_p, stg_c = catalog.stg_p(spark, sf), catalog.stg_c(spark, sf)
    first_day = stg_p.agg(F.min("price_date")).collect()[0][0]
    late = F.col("price_date") < F.lit(first_day + dt.timedelta(days=120))
    # Publish the later rows first; the early ones then arrive with a newer load time.
    published = marts.fct_prices(stg_p.filter(~late), stg_c)
    target = spark.createDataFrame(published.collect(), published.schema)
    arrived = stg_p.withColumn("ingested_at", F.when(
        late, F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")).otherwise(F.col("ingested_at")))
    full = marts.fct_prices(arrived, stg_c).drop("dbt_updated_at")
    merged = incremental.fct_incremental(arrived, stg_c, target).drop("dbt_updated_at")
    repaired = incremental.fct_incremental(arrived, stg_c, target, backfill=True) \
        .drop("dbt_updated_at")
    assert merged.count() == repaired.count() == full.count()
    assert merged.exceptAll(full).count() > 0            # stale sequences / averages remain
    assert repaired.exceptAll(full).count() == 0


def _bars(spark, rows):
    return spark.createDataFrame(rows, "id long, price_date date, v int")


def test_uncommitted_version_is_ignored(spark):
    """A version folder that no manifest names (a crashed write) is not the table and is rewritten."""
    from pricelake.plans import layers, warehouse
    from pricelake.session import scratch_path
    root = scratch_path(spark, "versions")
    base = f"{root}/MARTS/fct_stock_prices"
    rows = lambda n: spark.range(n).selectExpr("id", "date'2024-01-05' as price_date")
    layers.publish(rows(3), base, ["id"])
    for name in ("v=2", "d=2"):
        rows(5).write.parquet(f"{base}/{name}/part_month=2024-01")
    assert warehouse.current_path(spark, root, "fct_stock_prices").endswith("v=1")
    assert warehouse.current(spark, root, "fct_stock_prices").count() == 3
    layers.publish(rows(4), base, ["id"])
    assert warehouse.current(spark, root, "fct_stock_prices").count() == 4


def test_reads_do_not_grow_with_increments(spark):
    """Days are added to their month as folders, a month is folded after a few, corrected rows rewrite
    their month; a reader keeps the version it has, and what no version needs can be removed."""
    from pricelake.plans import layers
    from pricelake.session import scratch_path
    from pricelake.sources import manifest
    from pricelake.streaming.folders import list_names
    root = scratch_path(spark, "many")
    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
    want = {k: (day(k), 0) for k in range(40)}
    table = layers.publish(_bars(spark, [(k, *x) for k, x in want.items()]), root, ["price_date", "id"])
    first = table
    rows = lambda t: {r["id"]: (r["price_date"], r["v"]) for r in manifest.read(spark, t).collect()}
    most = 0
    for k in range(40, 64):
        batch = {k: (day(k), 1)} | ({5: (day(5), k)} if k == 50 else {})
        before = rows(table) if k in (47, 50) else None
        old = table
        table = layers.merge(spark, table, _bars(spark, [(i, *x) for i, x in batch.items()]), "id", ["price_date", "id"], folders=4)
        want |= batch
        if before is not None:
            assert rows(old) == before          # another reader's version is still whole
        most = max(most, max(map(len, table.parts.values())))
        assert len(table.folders()) <= 4 * len(table.parts)
    assert most == 4 and rows(table) == want and rows(first) == {k: (day(k), 0) for k in range(40)}
    assert len(table.parts["2024-01"]) == 1         # rewritten for the corrected row
    assert manifest.current(spark, root) == table
    folded = layers.fold(spark, table, ["price_date", "id"])
    assert rows(folded) == want and {len(fs) for fs in folded.parts.values()} == {1}
    assert layers.fold(spark, folded, ["price_date", "id"]) == folded
    gone = manifest.vacuum(spark, root, keep=1)
    left = {n for n in list_names(spark, root) if n[:2] in ("v=", "d=", "c=")}
    assert gone and left == {f.split("/")[0] for fs in folded.parts.values() for f in fs}
    assert rows(manifest.current(spark, root)) == want
    with pytest.raises(FileExistsError):
        manifest.commit(spark, root, folded.version, {}, manifest.read(spark, folded).schema)


def test_load_that_dies_leaves_the_old_rows(spark):
    """A full refresh whose write fails, or that ends before the commit, keeps the table readable."""
    from pricelake.session import scratch_path
    from pricelake.sources import files, manifest
    path = scratch_path(spark, "refresh")
    files.full_refresh(spark.range(10), path)
    fails = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("dies"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="dies"):
        files.full_refresh(fails, path)
    assert sorted(r["id"] for r in files.table(spark, path).collect()) == list(range(10))
    reader = files.table(spark, path)
    manifest.write_version(spark.range(5), path)                # written, never committed
    assert files.table(spark, path).count() == 10
    files.full_refresh(spark.range(7), path)
    assert files.table(spark, path).count() == 7 and reader.count() == 10
    with pytest.raises(FileNotFoundError):
        files.table(spark, path + "-none")


@pytest.mark.parametrize("backfill", [False, True])
def test_late_bar_reads_from_its_chunk_on(spark, backfill):
    """State per chunk: a late bar is computed from its chunk's first day, and equals a rebuild."""
    from pricelake.operators import series
    stg_p, stg_c = catalog.stg_p(spark, "/root/testdata/sf0.001"), catalog.stg_c(spark, "/root/testdata/sf0.001")
    kept = lambda df: spark.createDataFrame(df.collect(), df.schema)
    days = 400
    ticker = stg_p.groupBy("ticker").count().orderBy(F.desc("count"), "ticker").first()["ticker"]
    dates = sorted(r["price_date"] for r in stg_p.filter(F.col("ticker") == ticker).collect())
    missing, late_load = dates[-60], F.lit("2100-01-01 00:00:00").cast("timestamp_ntz")
    is_late = (F.col("ticker") == ticker) & (F.col("price_date") == F.lit(missing))
    early = kept(stg_p.filter(~is_late))
    batch, state = incremental.fct_increment(early, stg_c, None, chunk_days=days)
    target, state = kept(batch), kept(state)
    arrived = early.unionByName(stg_p.filter(is_late).withColumn("ingested_at", late_load))
    asked = []

    def history(since):
        asked.append(since)
        return early.filter(F.col("price_date") >= F.lit(since))

    batch, after = incremental.fct_increment(arrived, stg_c, target, state, backfill, history=history, chunk_days=days)
    chunk = (missing - dt.date(1970, 1, 1)).days // days
    assert asked == [dt.date(1970, 1, 1) + dt.timedelta(days=chunk * days)] and asked[0] > dates[0]
    cols = [c for c in target.columns if c != "dbt_updated_at"]
    full = marts.fct_prices(arrived, stg_c).select(cols)
    assert batch.count() == (60 if backfill else 1)
    assert batch.select(cols).exceptAll(full).count() == 0
    if backfill:
        assert incremental.upsert(target, batch, marts.FCT_KEY).select(cols).exceptAll(full).count() == 0
    want = series.series_state(arrived, chunk_days=days)
    assert after.select(*want.columns).exceptAll(want).count() == 0 and after.count() == want.count()


def test_empty_inputs(spark):
    """No price rows at all: every job still runs and returns empty / zero results."""
    from pricelake.operators import quality, series
    sf = "/root/testdata/sf0.001"
    empty = catalog.stg_p(spark, sf).filter(F.lit(False))
    assert series.series_metrics(empty).count() == 0
    fct = marts.fct_prices(empty, catalog.stg_c(spark, sf))
    assert fct.count() == 0 and fct.columns == marts.FCT_COLUMNS
    summary = quality.quality_summary(fct, "fct_stock_prices", "2024-01-31").collect()
    assert summary and all(r["failures"] == 0 for r in summary)
    assert quality.check_expected(fct, ["A", "B"]).count() == 2     # nothing arrived
    assert incremental.fct_incremental(empty, catalog.stg_c(spark, sf), fct).count() == 0
