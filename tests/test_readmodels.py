import datetime as dt
import statistics

from pyspark.sql import functions as F

from pricelake.operators import readmodels
from pricelake.session import scratch_path
from pricelake.sources import files

FCT = ("ticker string, price_date date, trading_day_seq int, open_price double, "
       "close_price double, daily_return_pct double, volume bigint, sector string, "
       "price_month date, vol_ma_7d bigint, vol_ma_30d bigint, high_price double, "
       "low_price double")


def fct(spark):
    rows = []
    d0 = dt.date(2024, 1, 1)
    for t, closes in (("A", [10.0 + i for i in range(40)]), ("B", [50.0 - i for i in range(35)]),
                      ("C", [5.0, 6.0])):
        prev = None
        for i, c in enumerate(closes):
            day = d0 + dt.timedelta(days=i)
            ret = None if prev is None else round((c - prev) / prev * 100, 4)
            rows.append((t, day, i + 1, c - 0.5, c, ret, 100 * (i + 1), "S" + t,
                         day.replace(day=1), 0, 0, c + 1.0, c - 1.0))
            prev = c
    return spark.createDataFrame(rows, FCT)


def test_top10_30d_and_best_performer(spark):
    f = fct(spark)
    top = {r["ticker"]: r for r in readmodels.top10_30d(f).collect()}
    assert set(top) == {"A", "B"}                     # C has fewer than 31 rows
    assert top["A"]["base_close"] == 19.0 and top["A"]["latest_close"] == 49.0
    assert top["A"]["return_30d_pct"] == round((49.0 - 19.0) / 19.0 * 100, 4)
    best = readmodels.best_performer(f, n=1).collect()[0]
    assert best["ticker"] == "A" and best["growth_pct"] == round((49 - 10) / 10 * 100, 4)


def test_risk_return_matches_statistics(spark):
    f = fct(spark)
    got = {r["ticker"]: r for r in readmodels.risk_return(f).collect()}
    for t in ("A", "B"):
        rets = [r["daily_return_pct"] for r in f.filter(F.col("ticker") == t).collect()
                if r["daily_return_pct"] is not None]
        assert got[t]["return_days"] == len(rets)
        assert abs(got[t]["stddev_daily_return_pct"] - statistics.stdev(rets)) < 1e-4
    assert got["C"]["stddev_daily_return_pct"] is None    # one return: no sample deviation


def test_volume_direction_and_rank(spark):
    f = fct(spark)
    dirs = {r["direction"] for r in readmodels.volume_series(f, "A").collect()}
    assert dirs == {"Up"}                               # close >= open everywhere
    rank = readmodels.avg_volume_rank(f, n=2).collect()
    assert [r["ticker"] for r in rank] == ["A", "B"]


def test_series_filter_reaches_the_scan(spark):
    path = scratch_path(spark, "mart")
    files.write_clustered(fct(spark), path, ["price_date", "ticker"], partitions=2)
    q = readmodels.ohlcv_series(spark.read.parquet(path), "A", "2024-01-10", "2024-01-20")
    plan = spark._jvm.PythonSQLUtils.explainString(q._jdf.queryExecution(), "formatted")
    assert "EqualTo(ticker,A)" in plan and "GreaterThanOrEqual(price_date,2024-01-10)" in plan
    assert q.count() == 11


def test_tables_that_follow_the_fact_table(spark):
    """After an increment only its months are computed; the read models and the tests read no other
    fact rows and equal those of the whole table."""
    from pricelake.operators import marts, quality
    from pricelake.plans import catalog, layers, monthly
    from pricelake.session import scratch_path
    from pricelake.sources import manifest

    sf = "/root/testdata/sf0.001"
    whole = catalog.fct_mart(spark, sf)
    root = scratch_path(spark, "following")
    cut = F.lit("1998-05-01").cast("date")
    table = layers.publish(whole.filter(F.col("price_date") < cut), f"{root}/fct", marts.FCT_CLUSTER)
    asked = []

    def computed(compute):
        def run(fact):
            asked.append({r[0] for r in fact.select(layers.MONTH).distinct().collect()})
            return compute(fact)
        return run

    def both(table):
        return [manifest.read(spark, monthly.follow(spark, table, f"{root}/{c.__name__}", computed(c))) for c in (monthly.figures, monthly.violations)]

    both(table)
    first = [set(m) for m in asked]
    broken = whole.filter(F.col("price_date").between(cut, F.lit("1998-05-20"))).withColumn(
        "low_price", F.when(F.dayofmonth("price_date") == 7, F.lit(-1.0)).otherwise(F.col("low_price")))
    table = layers.merge(spark, table, broken.unionByName(broken.filter(F.dayofmonth("price_date") == 8)), marts.FCT_KEY, marts.FCT_CLUSTER)
    sums, counts = both(table)
    assert first[0] == first[1] == set(table.parts) - {"1998-05"} and asked[2:] == [{"1998-05"}, {"1998-05"}]
    both(table)
    assert len(asked) == 4
    fact = manifest.read(spark, table)
    for new, old in ((monthly.risk_return(sums), readmodels.risk_return(fact)), (monthly.sector_performance(sums), readmodels.sector_performance(fact))):
        assert sorted(map(str, new.collect())) == sorted(map(str, old.select(*new.columns).collect()))
        assert all("/figures/" in f for f in new.inputFiles())
    dim = catalog.dim_mart(spark, sf).limit(5)
    as_of = "1998-05-10"
    later = manifest.read(spark, table, [m for m in table.parts if m >= as_of[:7]])
    got = monthly.summary(counts, sums, dim, later, as_of, ["A", "SUPPLIER#000000001"])
    want = quality.run_all(spark, {"fct_stock_prices": fact, "dim_companies": dim}, as_of, ["A", "SUPPLIER#000000001"])
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r) for r in want.collect() if r["model"] == "fct_stock_prices")
    failing = {r["rule"] for r in got.collect() if r["failures"]}
    assert {"positive_prices", "unique", "no_future_dates", "fct_dim_referential_integrity", "all_tickers_present"} <= failing
