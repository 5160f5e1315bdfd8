import datetime as dt

from pricelake.operators import quality

FCT = ("ticker string, price_date date, open_price double, high_price double, low_price double, "
       "close_price double, volume bigint, daily_return_pct double, trading_day_seq int, "
       "sma_7d double, sma_30d double, sma_90d double")


def broken(spark):
    d = dt.date(2024, 1, 2)
    return spark.createDataFrame([
        ("A", d, 1.0, 2.0, 1.0, 1.5, 10, 80.0, 1, 1.0, 1.0, 1.0),      # return > 75
        ("A", d, 1.0, 1.0, 2.0, 1.5, 10, -80.0, 2, 1.0, 1.0, 1.0),     # high < low, return < -75
        ("B", d, 0.0, 2.0, 1.0, 1.5, -1, None, 91, None, 1.0, 1.0),    # non-positive, sma null
        ("C", dt.date(2030, 1, 1), 1.0, 2.0, 1.0, 1.5, 10, 1.0, 3, 1.0, 1.0, 1.0),   # future
        ("D", d, 1.0, 2.0, 1.0, 1.5, 10, 75.0, 4, 1.0, 1.0, 1.0),      # clean (bound inclusive)
    ], FCT)


def test_singular_checks_on_broken_rows(spark):
    f = broken(spark)
    assert quality.check_return_bounds(f).count() == 2
    assert quality.check_high_low(f).count() == 1
    assert quality.check_positive(f).count() == 1
    assert quality.check_sma_warm(f).count() == 1
    assert quality.check_no_future(f, "2024-06-01").count() == 1
    assert quality.check_not_null(f, "daily_return_pct").count() == 1


def test_unique_and_accepted(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "x string")
    assert [tuple(r) for r in quality.check_unique(df, "x").collect()] == [("a", 2)]
    assert quality.check_accepted(df, "x", ["a"]).count() == 1       # 'b'; nulls pass


def test_expected_not_in_semantics(spark):
    fct = spark.createDataFrame([("A",), ("B",)], "ticker string")
    assert [r[0] for r in quality.check_expected(fct, ["A", "C"]).collect()] == ["C"]
    with_null = spark.createDataFrame([("A",), (None,)], "ticker string")
    assert quality.check_expected(with_null, ["A", "C"]).count() == 0    # NOT IN with a null


def test_referential(spark):
    fct = spark.createDataFrame([("A",), ("A",), ("Z",), (None,)], "ticker string")
    dim = spark.createDataFrame([("A",)], "ticker string")
    got = sorted(quality.check_referential(fct, dim).collect(), key=lambda r: str(r[0]))
    assert [r[0] for r in got] == [None, "Z"]     # sorted by str(): "None" < "Z"


def test_fused_summary_counts(spark):
    f = broken(spark)
    rules = {(r["rule"], r["column_name"]): r["failures"]
             for r in quality.quality_summary(f, "fct_stock_prices", "2024-06-01").collect()}
    assert rules[("daily_return_within_bounds", "daily_return_pct")] == 2
    assert rules[("high_price_gte_low_price", "high_price")] == 1
    assert rules[("positive_prices", "close_price")] == 1
    assert rules[("no_future_dates", "price_date")] == 1
    assert rules[("sma_not_null_after_warm_up", "sma_90d")] == 1
    assert rules[("not_null", "sma_7d")] == 1
