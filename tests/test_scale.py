"""What large tables need: rows shuffled once and narrow, parts computed once, no task per group."""

import datetime as dt

from pyspark.sql import functions as F

from pricelake import session
from pricelake.functions.scalar import packed, unpacked
from pricelake.operators import incremental, intermediate, joblog, marts, quality, series, staging
from pricelake.plans import catalog, layers, monthly
from pricelake.session import scratch_path
from pricelake.sources import driver_tables, files, manifest
from pricelake.streaming import file_stream
from pricelake.streaming.folders import list_names
from tests.conftest import SF_SMALL


def staged(spark, tickers=("A", "B"), days=6):
    raw = [(str(dt.date(2020, 1, 1) + dt.timedelta(days=400 * k)), "1.5", "3", "1", str(1.25 + k), str(10 * k), t,
            dt.datetime(2020, 1, 1) + dt.timedelta(days=400 * k + 1)) for t in tickers for k in range(days)]
    names = "date string, open string, high string, low string, close string, volume string, ticker string, ingested_at timestamp_ntz"
    return staging.stg_prices(spark.createDataFrame(raw, names), "2024-01-01")


def companies(spark, tickers=("A",)):
    kind = ", ".join(f"{c} {'double' if c == 'market_cap_usd' else 'long' if c == 'full_time_employees' else 'string'}"
                     for c in ["ticker", *series.COMPANY_COLUMNS])
    return spark.createDataFrame([(t, f"id{t}", f"{t} Inc", "s", "i", "c", "e", "usd", 1.0, "x", 5) for t in tickers], kind)


def test_companies_are_joined_where_the_series_rows_are(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "false" if k.endswith("enabled") else "-1")
        df = marts.fct_prices(staged(spark), companies(spark))
        plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
        at = next(i for i, x in enumerate(plan) if "SortMergeJoin" in x and "LeftOuter" in x)
        below = [x for x in plan[at + 1:]]
        assert "Exchange" not in " ".join(below[:next(i for i, x in enumerate(below) if "Window " in x)])
        got = {(r["ticker"], r["trading_day_seq"]): r["company_name"] for r in df.collect()}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == {(t, k): "A Inc" if t == "A" else None for t in "AB" for k in range(1, 7)}


def test_derived_columns_are_computed_where_rows_are_written(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), "A", 1, 99), (dt.date(2020, 2, 1), "B", 2, 99)], "price_date date, ticker string, x int, twice int")
    root = scratch_path(spark, "derived")
    table = layers.publish(df, root, ["price_date", "ticker"], derived={"twice": F.col("x") * 2})
    got = manifest.read(spark, table)
    assert got.columns == df.columns and sorted(r["twice"] for r in got.collect()) == [2, 4]


def test_derived_fact_columns_equal_the_computed_ones(spark):
    whole = catalog.fct(spark, SF_SMALL).drop("dbt_updated_at")
    again = whole.withColumns(marts.fct_derived())
    assert whole.count() > 0 and whole.exceptAll(again).count() == 0
    assert whole.dtypes == again.dtypes


def test_state_serves_the_rows_of_a_first_build(spark):
    stg, kept = staged(spark), []
    batch, state = incremental.fct_increment(stg, companies(spark), None, keep_state=lambda df: kept.append(df) or df.checkpoint(), chunk_days=500)
    want = marts.fct_prices(stg, companies(spark), chunk_days=500)
    assert len(kept) == 1 and batch.exceptAll(want).count() == 0 and batch.count() == want.count() == 12
    assert state.agg(F.sum("_n")).collect()[0][0] == 12


def test_packed_texts_are_told_apart(spark):
    key = "0123456789abcdef0123456789abcdef"
    texts = [key, key.upper(), key + "\n", "", "x", bytes.fromhex(key[:14] + "41").decode("latin-1"), "\0" + "a" * 15, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed("t").alias("p"))
    got = df.select("t", "p", unpacked("p").alias("u")).collect()
    assert all(r["t"] == r["u"] for r in got)
    assert len({bytes(r["p"]) for r in got if r["p"] is not None}) == len(texts) - 1
    assert [len(r["p"]) for r in got if r["t"] == key] == [17]


def test_uniqueness_is_one_shuffle_of_packed_keys(spark):
    keys = ["0123456789abcdef0123456789abcdef", "plain", None]
    df = spark.createDataFrame([(k,) for k in keys * 2] + [("once",)], "k string")
    found = quality.check_unique(df, "k")
    assert sorted(map(tuple, found.collect())) == [(keys[0], 2), ("plain", 2)]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    numbers = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert list(map(tuple, quality.check_unique(numbers, "k").collect())) == [(1, 2)]


def test_monthly_uniqueness(spark):
    stg = staged(spark)
    fact = marts.fct_prices(stg.unionByName(stg.filter("ticker = 'A'").limit(2)), companies(spark))
    counts = monthly.violations(fact.withColumn(layers.MONTH, F.date_format("price_date", "yyyy-MM")))
    again = counts.filter("rule = 'unique'").collect()
    assert sum(r["failures"] for r in again) == 2


def test_late_rows_are_computed_from_stored_parts(spark):
    stg, firms, names = staged(spark), companies(spark), []
    early, late = stg.filter("ticker = 'A' or volume <> 30"), stg.filter("ticker = 'B' and volume = 30")

    def keep_part(name, df):
        names.append(name)
        return df.checkpoint()

    state = series.series_state(early, chunk_days=500)
    batch, after = incremental.increment_of(late, incremental.staged(early), firms, state, True, ["ingested_at"], 500, keep_part)
    want = marts.fct_prices(stg, firms, chunk_days=500).filter("ticker = 'B' and volume >= 30")
    assert names == ["late", "scope", "chunks"]
    assert batch.count() == want.count() == 3 and batch.exceptAll(want).count() == 0
    full = series.series_state(stg, chunk_days=500)
    assert after.select(full.columns).exceptAll(full).count() == 0 and after.count() == full.count()


def test_overlapping_batch_is_computed_once(spark):
    merged = catalog.QUERIES["upsert_duplicates"](spark, SF_SMALL)
    assert not [f for f in merged.inputFiles() if "/RAW/" in f]


def test_layout_of_folders_of_several_files(spark):
    df = spark.range(60).select(F.expr("date '2020-01-01' + cast(id as int)").alias("price_date"), F.lit("T").alias("ticker"),
                                F.expr("if(id < 30, '01', '1')").alias("part"))
    path = scratch_path(spark, "folders")
    df.repartition(3).write.partitionBy("part").parquet(path)
    got = joblog.layout_report(spark, [path], marts.FCT_CLUSTER, joblog.FOLDER).collect()[0]
    assert (got["total_units"], got["total_rows"], got["max_depth"], got["average_overlaps"]) == (2, 60, 1, 0.0)


def test_series_pass_moves_no_column_that_follows_from_others(spark):
    for df in (intermediate.moving_averages(staged(spark), companies(spark)), intermediate.daily_returns(staged(spark), companies(spark)),
               marts.fct_prices(staged(spark), companies(spark)),
               series.series_metrics(catalog.adjusted(staged(spark)), derived=catalog.adjusted_derived())):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        at = plan.index("Window")
        assert "md5(" in plan[:at] and "md5(" not in plan[at:]
    key = ["stock_price_id", "ticker", "price_date", "price_change", "pct_change_open_to_close"]
    got = intermediate.moving_averages(staged(spark), companies(spark)).select(key)
    assert got.count() == 12 and got.exceptAll(staged(spark).select(key)).count() == 0
    adjusted = catalog.adjusted(staged(spark))
    got = series.series_metrics(adjusted, derived=catalog.adjusted_derived()).select(key)
    assert got.count() == 12 and got.exceptAll(adjusted.select(key)).count() == 0


def test_rejects_are_told_apart_without_their_names(spark):
    df = spark.createDataFrame([("1", "2020-01-01", "t"), ("x", "2020-01-01", None), ("x", "y", "u"), (None, None, None)], "n string, d string, s string")
    types = {"n": "bigint", "d": "date", "s": "string"}
    for more in (False, True):
        rows = df.withColumn(files.MALFORMED, F.when(F.col("s") == "t", "line")) if more else df
        good, rejects = files.split_rejects(rows, types)
        assert sorted(r["reject_columns"] for r in rejects.collect()) == ["n", "n,d"] + ["record"] * more
        assert sorted((r["n"] or 0, r["s"] or "") for r in good.collect()) == [(0, "")] + [(1, "t")] * (not more)
        plan = good._jdf.queryExecution().optimizedPlan().toString()
        assert "CASE WHEN" not in plan.split("LogicalRDD")[0].replace("CASE WHEN (s", "")


def test_lines_are_dealt_once_and_sorted_once(spark):
    for df in (driver_tables.supplier_bars(spark, SF_SMALL), driver_tables.event_bars(spark, SF_SMALL)):
        plan = df._jdf.queryExecution().sparkPlan().toString().split("\n")
        at = [i for i, x in enumerate(plan) if "Repartition" in x or "Exchange" in x]
        aggregates = [i for i, x in enumerate(plan) if "Aggregate" in x]
        assert len(at) == 1 and aggregates and max(aggregates) < at[0]      # none before the shuffle
    lines = driver_tables.table(spark, SF_SMALL, "lineitem")
    bars = driver_tables.supplier_bars(spark, SF_SMALL)
    want = lines.groupBy("l_suppkey", F.to_date("l_shipdate").alias("d")).agg(
        F.max("l_extendedprice").alias("h"), F.min("l_extendedprice").alias("l"), F.sum("l_quantity").cast("bigint").alias("v"))
    got = bars.select(want.columns)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_state_aggregates_only_the_tails(spark):
    stats = series.chunk_stats(staged(spark, days=8), "ticker", "price_date", 30_000, 2, True, "ingested_at")
    plan = stats._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert "Aggregate" in plan[0] and any("Filter" in x and "_pos" in x and "_n" in x for x in plan[1:4])
    got = {r["ticker"]: r for r in stats.collect()}
    assert set(got) == {"A", "B"}
    for r in got.values():
        assert (r["_n"], r["_first_c"], r["_last_c"], r["_in_rn"]) == (8, 1.25, 8.25, 7)
        assert [x["c"] for x in r["_tail"]] == [7.25, 8.25]
        closes = [1.25 + k for k in range(8)]
        assert r["_in_rs"] == sum(round(100 * (b - a) / a * 10000) for a, b in zip(closes, closes[1:]))
        assert r["_hwm"] == dt.datetime(2020, 1, 1) + dt.timedelta(days=400 * 7 + 1)


def test_jobs_with_wide_sorts_get_small_tasks(spark):
    old = spark.conf.get(session.ADVISORY, None)
    try:
        spark.conf.unset(session.ADVISORY)
        with session.small_tasks(spark):
            assert spark.conf.get(session.ADVISORY) == str(session.TASK_BYTES)
        assert spark.conf.get(session.ADVISORY, None) is None
        spark.conf.set(session.ADVISORY, "5MB")
        with session.small_tasks(spark):
            assert spark.conf.get(session.ADVISORY) == "5MB"
        assert spark.conf.get(session.ADVISORY) == "5MB"
    finally:
        spark.conf.unset(session.ADVISORY) if old is None else spark.conf.set(session.ADVISORY, old)


def test_rows_outside_the_range_of_a_batch_are_not_joined(spark):
    names = "k string, d date, x int"
    day = lambda n: dt.date(2020, 1, n)
    target = spark.createDataFrame([("a", day(1), 1), ("b", day(2), 1), ("c", day(3), 1), ("e", day(9), 1), ("n", None, 1), (None, None, 1)], names)
    for batch in ([("c", day(3), 2), ("f", day(4), 2), ("n", None, 2)], [("n", None, 2)], [], [("b", day(2), 2), ("b", day(2), 3)]):
        rows = spark.createDataFrame(batch, names)
        got = incremental.upsert(target, rows, "k", follows="d")
        want = incremental.upsert(target, rows, "k")
        assert got.columns == want.columns and got.count() == want.count() and got.exceptAll(want).count() == 0
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "scalar-subquery" in plan.split("LeftAnti")[1] and "scalar-subquery" in plan.split("LeftAnti")[0]


def test_latest_bars_are_grouped_by_what_their_key_is_made_of(spark):
    stg = staged(spark)
    again = stg.unionByName(stg.withColumns({"volume": F.col("volume") + 1}))
    again = again.unionByName(stg.filter("ticker = 'A'").withColumn("ingested_at", F.col("ingested_at") + F.expr("interval 1 day")))
    again = again.unionByName(stg.withColumn("close_price", F.lit(2.5)).drop(*staging.price_derived()).withColumns(staging.price_derived()))
    got = incremental.latest_bars(again, ["ingested_at"])
    want = incremental.latest_per_key(again, marts.FCT_KEY, ["ingested_at"])
    assert got.columns == want.columns and got.count() == want.count() == 12 and got.exceptAll(want).count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    at = plan.index("Window")
    assert "md5(" in plan[:at] and "stock_price_id" not in plan[at:].split("LocalRelation")[0].split("Union")[0]
    assert "WindowGroupLimit" in plan                    # a bar that comes often does not travel whole


def test_stored_rows_hold_no_column_that_follows_from_others(spark):
    stg, path = staged(spark), scratch_path(spark, "narrow")
    back = files.stored(stg, path, staging.price_derived())
    assert set(spark.read.parquet(path).columns) == set(stg.columns) - set(staging.price_derived())
    assert back.columns == stg.columns and back.dtypes == stg.dtypes
    assert back.count() == 12 and back.exceptAll(stg).count() == 0


def test_micro_batches_leave_only_what_later_ones_need(spark):
    work, prices = scratch_path(spark, "stream-parts"), catalog.Warehouse.of(spark, SF_SMALL).stage("raw_stock_prices")
    late = F.dayofmonth(F.to_date("date")) == 10
    for epoch, rows in enumerate((prices.filter(~late), prices.filter(late))):
        file_stream.process_batch(spark, rows, epoch, f"{work}/history", f"{work}/target", catalog.stg_c(spark, SF_SMALL))
    left = {n: list_names(spark, f"{work}/{n}") for n in list_names(spark, work)}
    assert [x for x in left["target-state"] if "=" in x] == ["v=1", "v=2"]
    assert not [n for p in file_stream.PARTS for n in left.get(f"target-{p}", []) if "v=" in n]
    full = marts.fct_prices(staging.stg_prices(prices), catalog.stg_c(spark, SF_SMALL)).drop("dbt_updated_at")
    got = file_stream.latest(spark, f"{work}/target").select(full.columns)
    assert got.count() == full.count() > 0 and got.exceptAll(full).count() == 0


def test_merge_reads_only_months_that_keep_rows(spark, monkeypatch):
    stg, firms = staged(spark, ("A", "B"), 4), companies(spark)
    fact = marts.fct_prices(stg, firms)
    table = layers.publish(fact, scratch_path(spark, "mixed"), marts.FCT_CLUSTER, derived=marts.fct_derived())
    months = sorted(table.parts)
    fixed = (F.col("price_month") == f"{months[1]}-01") | ((F.col("price_month") == f"{months[2]}-01") & (F.col("ticker") == "A"))
    new = staged(spark, ("C",), 4).filter(F.date_format("price_date", "yyyy-MM") == months[0])
    batch = fact.filter(fixed).withColumn("volume", F.lit(5).cast("bigint")).unionByName(marts.fct_prices(new, firms))
    read, seen = manifest.read, []
    monkeypatch.setattr(manifest, "read", lambda s, t, parts=None: seen.append(parts) or read(s, t, parts))
    stored = files.stored(batch, scratch_path(spark, "mixed-batch"), marts.fct_derived())
    found = layers.merge(spark, table, stored, marts.FCT_KEY, marts.FCT_CLUSTER, derived=marts.fct_derived(), parts=marts.FCT_PARTS)
    assert sorted(seen[0]) == months[:3] and seen[1:] == [[months[2]]]
    got, want = read(spark, found), incremental.upsert(fact, batch, marts.FCT_KEY)
    assert got.count() == want.count() == 9 and got.exceptAll(want.select(got.columns)).count() == 0
    assert [len(found.parts[m]) for m in months] == [2, 1, 1, 1]


def test_upsert_by_what_the_key_is_made_of(spark):
    fact = marts.fct_prices(staged(spark), companies(spark)).withColumn("from_batch", F.lit(False))
    batch = fact.filter("ticker = 'B' and volume >= 20").withColumns({"from_batch": F.lit(True), "volume": F.col("volume") + 7})
    want = incremental.upsert(fact, batch, marts.FCT_KEY)
    for follows in (None, "price_date"):
        got = incremental.upsert(fact, batch, marts.FCT_KEY, follows=follows, parts=marts.FCT_PARTS, derived=marts.fct_derived())
        assert got.columns == want.columns and got.count() == want.count() == 12 and got.exceptAll(want).count() == 0
    every = batch.unionByName(batch.withColumn("ingested_at", F.col("ingested_at") - F.expr("interval 1 hour"))).unionByName(batch)
    every = every.unionByName(batch.withColumn("high_price", F.col("high_price") + 1).drop(*marts.fct_derived()).withColumns(marts.fct_derived()).select(*batch.columns))
    want = incremental.latest_per_key(every, marts.FCT_KEY, ["ingested_at"])
    got = incremental.latest_per_key(every, marts.FCT_KEY, ["ingested_at"], marts.FCT_PARTS, marts.fct_order_free())
    assert got.columns == want.columns and got.count() == want.count() == 4 and got.exceptAll(want).count() == 0


def test_written_tables_leave_no_shuffle_files(spark):
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    known = lambda: tracker.shuffleStatuses().size()
    table = layers.publish(marts.fct_prices(staged(spark), companies(spark)), scratch_path(spark, "clean"), marts.FCT_CLUSTER)
    before = known()
    stored = files.stored(manifest.read(spark, table).groupBy("ticker").agg(F.count(F.lit(1)).alias("n")), scratch_path(spark, "clean-n"))
    layers.publish(marts.fct_prices(staged(spark), companies(spark)), scratch_path(spark, "clean"), marts.FCT_CLUSTER)
    assert known() <= before and sorted(map(tuple, stored.collect())) == [("A", 6), ("B", 6)]
    assert spark.conf.get(session.CLEANUP, None) is None
