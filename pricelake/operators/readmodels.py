"""Read queries on the published fact table (the dashboard's questions).

All of them are filters, projections or per-key aggregations with partial (map-side)
aggregation; ranking queries use a bounded top-k (``orderBy().limit()``, planned as
``TakeOrderedAndProject``) and never sort or collect a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.scalar import exact_avg, safe_divide

TOP_N = 10
RETURN_WINDOW_ROWS = 30
UP, DOWN = "Up", "Down"


def _series(fct: DataFrame, columns: list, ticker=None, start=None, end=None) -> DataFrame:
    """Columns of the fact rows of a ticker and date range.  One ticker's rows come in order of
    date; the rows of all tickers are not sorted, as that would shuffle the whole table."""
    out = fct
    if ticker is not None:
        out = out.filter(F.col("ticker") == ticker)
    if start is not None:
        out = out.filter(F.col("price_date") >= F.lit(start).cast("date"))
    if end is not None:
        out = out.filter(F.col("price_date") <= F.lit(end).cast("date"))
    out = out.select(*columns)
    return out if ticker is None else out.orderBy("price_date")


def ohlcv_series(fct: DataFrame, ticker=None, start=None, end=None) -> DataFrame:
    """OHLCV bars for a ticker (all when None) and a date range.  On the clustered fact table
    the date/ticker predicates become parquet row-group filters (``PushedFilters``)."""
    return _series(fct, ["ticker", "price_date", "open_price", "high_price", "low_price",
                         "close_price", "volume"], ticker, start, end)


def sma_series(fct: DataFrame, ticker=None, start=None, end=None) -> DataFrame:
    return _series(fct, ["ticker", "price_date", "close_price", "sma_7d", "sma_30d", "sma_90d"],
                   ticker, start, end)


def up_down(close="close_price", open_="open_price") -> Column:
    return F.when(F.col(close) >= F.col(open_), UP).otherwise(DOWN)


def volume_series(fct: DataFrame, ticker=None, start=None, end=None) -> DataFrame:
    return _series(fct, ["ticker", "price_date", "volume", up_down().alias("direction"),
                         "vol_ma_7d", "vol_ma_30d"], ticker, start, end)


def returns_heatmap(fct: DataFrame) -> DataFrame:
    """Ticker x month cells (long form): mean daily return and trading days per cell."""
    return fct.groupBy("ticker", "price_month").agg(
        exact_avg("daily_return_pct", 4, 4).alias("avg_daily_return_pct"),
        F.count(F.lit(1)).alias("trading_days"))


def sector_performance(fct: DataFrame) -> DataFrame:
    return fct.groupBy("sector").agg(
        exact_avg("daily_return_pct", 4, 4).alias("avg_daily_return_pct"),
        F.countDistinct("ticker").alias("tickers"),
        F.sum("volume").alias("total_volume"),
        F.count(F.lit(1)).alias("trading_days"))


def risk_return(fct: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of daily return per ticker.

    Both come from exact integer sums of the 4-decimal returns (``u = return * 10^4``):
    ``var = (n * sum(u^2) - sum(u)^2) / (n * (n - 1)) / 10^8``, so the result does not depend on
    the order rows are summed in."""
    u = F.round(F.col("daily_return_pct") * 10000).cast("decimal(38,0)")
    g = fct.groupBy("ticker").agg(
        exact_avg("daily_return_pct", 4, 4).alias("avg_daily_return_pct"),
        F.count("daily_return_pct").alias("return_days"),
        F.sum(u).alias("_s1"), F.sum(u * u).alias("_s2"))
    n = F.col("return_days").cast("decimal(38,0)")
    num = (n * F.col("_s2") - F.col("_s1") * F.col("_s1")).cast("double")
    den = (n * (n - 1)).cast("double")
    std = F.when(F.col("return_days") > 1, F.round(F.sqrt(num / den) / 10000, 4))
    return g.select("ticker", "avg_daily_return_pct", std.alias("stddev_daily_return_pct"),
                    "return_days")


def _latest_and_back(fct: DataFrame, back: int) -> DataFrame:
    """Per ticker the latest close and the close ``back`` rows earlier: one aggregate gives the
    latest row, one equi-join on (ticker, trading_day_seq) the earlier one."""
    now = (fct.groupBy("ticker")
           .agg(F.max(F.struct("trading_day_seq", "price_date", "close_price")).alias("l"))
           .select("ticker", (F.col("l.trading_day_seq") - back).alias("trading_day_seq"),
                   F.col("l.price_date").alias("latest_date"),
                   F.col("l.close_price").alias("latest_close")))
    earlier = fct.select("ticker", "trading_day_seq", F.col("close_price").alias("base_close"),
                         F.col("price_date").alias("base_date"))
    return now.join(earlier, ["ticker", "trading_day_seq"]).select(
        "ticker", "base_date", "base_close", "latest_date", "latest_close")


def top10_30d(fct: DataFrame, n: int = TOP_N, back: int = RETURN_WINDOW_ROWS) -> DataFrame:
    """Tickers with the highest return over the last ``back`` trading rows."""
    p = _latest_and_back(fct, back)
    ret = F.round(safe_divide(F.col("latest_close") - F.col("base_close"), "base_close") * 100, 4)
    return (p.withColumn("return_30d_pct", ret)
            .orderBy(F.col("return_30d_pct").desc_nulls_last(), F.col("ticker").asc())
            .limit(n))


def avg_volume_rank(fct: DataFrame, n: int = TOP_N) -> DataFrame:
    return (fct.groupBy("ticker").agg(exact_avg("volume", 0, 2).alias("avg_volume"))
            .orderBy(F.col("avg_volume").desc_nulls_last(), F.col("ticker").asc()).limit(n))


def best_performer(fct: DataFrame, n: int = TOP_N) -> DataFrame:
    """Growth from the first to the last close of each ticker's history (``min_by`` /
    ``max_by`` on date are plain aggregates, partially aggregated per task)."""
    g = fct.groupBy("ticker").agg(
        F.min("price_date").alias("first_date"), F.max("price_date").alias("last_date"),
        F.min_by("close_price", "price_date").alias("first_close"),
        F.max_by("close_price", "price_date").alias("last_close"))
    growth = F.round(safe_divide(F.col("last_close") - F.col("first_close"), "first_close")
                     * 100, 4)
    return (g.withColumn("growth_pct", growth)
            .orderBy(F.col("growth_pct").desc_nulls_last(), F.col("ticker").asc()).limit(n))
