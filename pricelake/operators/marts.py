"""Mart jobs: the price fact table and the company dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.scalar import day_of_week0, safe_divide, sma_signal, trunc_date
from pricelake.operators.intermediate import company_columns
from pricelake.operators.series import daily_return, series_metrics
from pricelake.operators.staging import STG_COMPANY_COLUMNS, price_derived

FCT_COLUMNS = [
    "stock_price_id", "ticker", "company_name", "sector", "industry", "country", "exchange",
    "currency", "market_cap_category", "price_date", "price_week", "price_month", "price_year",
    "day_of_week", "trading_day_seq", "open_price", "high_price", "low_price", "close_price",
    "prev_close_price", "volume", "price_change", "pct_change_open_to_close", "daily_return_pct",
    "intraday_range", "intraday_range_pct", "cumulative_avg_return_pct", "sma_7d", "sma_30d",
    "sma_90d", "vol_ma_7d", "vol_ma_30d", "price_vs_sma_30d", "market_cap_usd",
    "full_time_employees", "ingested_at", "dbt_updated_at",
]
DIM_COLUMNS = list(STG_COMPANY_COLUMNS)

FCT_KEY = "stock_price_id"
#: What the key is the digest of.
FCT_PARTS = ["ticker", "price_date"]
DIM_KEY = "company_id"
FCT_CLUSTER = ["price_date", "ticker"]
DIM_CLUSTER = ["sector", "ticker"]


def fct_select(ma: DataFrame) -> DataFrame:
    """Publish a moving-averages frame as the fact layout: date buckets, 37 columns."""
    return ma.select(
        *[F.col(c) for c in FCT_COLUMNS[:10]],
        trunc_date("week", "price_date").alias("price_week"),
        trunc_date("month", "price_date").alias("price_month"),
        trunc_date("year", "price_date").alias("price_year"),
        day_of_week0("price_date").alias("day_of_week"),
        *[F.col(c) for c in FCT_COLUMNS[14:]],
    )


def fct_prices(stg_p: DataFrame, stg_c: DataFrame, **series_opts) -> DataFrame:
    """Full build of the fact table from staged prices and companies.

    Plan order differs from the view stack but not the result: the window passes run on the
    narrow price columns and the company attributes are attached once, after them, so the two
    big shuffles do not carry ten company columns.  They are joined by (ticker, chunk), as the passes
    are partitioned, so the finished rows are not shuffled for it."""
    return fct_select(series_metrics(stg_p, attach=company_columns(stg_c), derived=price_derived(), **series_opts))


def fct_derived() -> dict[str, Column]:
    """Columns of a fact row that follow from its others, by the expressions that staging, the series and
    ``fct_select`` use: a shuffle of fact rows need not carry them."""
    close, spread = F.col("close_price"), F.col("high_price") - F.col("low_price")
    return {
        **price_derived(),
        "price_week": trunc_date("week", "price_date"),
        "price_month": trunc_date("month", "price_date"),
        "price_year": trunc_date("year", "price_date"),
        "day_of_week": day_of_week0("price_date"),
        "daily_return_pct": daily_return(close, F.col("prev_close_price")),
        "intraday_range": F.round(spread, 4),
        "intraday_range_pct": F.round(safe_divide(spread, close) * 100, 4),
        "price_vs_sma_30d": sma_signal("close_price", "sma_30d"),
    }


def fct_order_free() -> dict[str, Column]:
    """Those of ``fct_derived`` that decide no order by all columns (by name): they follow from the key, or from
    columns whose names come before theirs."""
    other = ("daily_return_pct", "intraday_range", "intraday_range_pct", "price_vs_sma_30d")
    return {c: x for c, x in fct_derived().items() if c not in other}


def dim_companies(stg_c: DataFrame) -> DataFrame:
    return stg_c.select(*DIM_COLUMNS)
