"""Staging jobs: rename, cast, validate, key and derive; company de-duplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.functions.scalar import (
    cap_category,
    initcap_words,
    safe_divide,
    surrogate_key,
)

STG_PRICE_COLUMNS = [
    "stock_price_id", "ticker", "price_date", "open_price", "high_price", "low_price",
    "close_price", "volume", "price_change", "pct_change_open_to_close", "ingested_at",
    "dbt_updated_at",
]
STG_COMPANY_COLUMNS = [
    "company_id", "ticker", "company_name", "sector", "industry", "country", "exchange",
    "currency", "market_cap_usd", "market_cap_category", "full_time_employees", "website",
    "ingested_at", "dbt_updated_at",
]


def updated_at(as_of=None) -> Column:
    """Audit stamp: the given ``as_of`` (keeps results reproducible) or the current time."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def _is_text(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


def to_bigint(df: DataFrame, c: str) -> Column:
    """Lenient integer cast: text such as '164000.0' is read as a decimal, with all its digits, and
    rounded."""
    if _is_text(df, c):
        return F.round(F.col(c).try_cast("decimal(38,6)")).try_cast("bigint")
    return F.col(c).try_cast("bigint")


def valid_prices() -> Column:
    """Keys and the four prices present, prices positive, high >= low.  Volume is not checked."""
    prices = ["close_price", "open_price", "high_price", "low_price"]
    present = reduce(lambda a, b: a & b,
                     [F.col(c).isNotNull() for c in ["ticker", "price_date", *prices]])
    positive = reduce(lambda a, b: a & b, [F.col(c) > 0 for c in prices])
    return present & positive & (F.col("high_price") >= F.col("low_price"))


def valid_companies() -> Column:
    return (F.col("ticker").isNotNull() & (F.trim("ticker") != "")
            & F.col("company_name").isNotNull())


def dedup_top1(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row per key under ``order``.  Catalyst plans this as a partial
    ``WindowGroupLimit`` before the shuffle, so each map task sends at most one row per key
    (a hot key never ships its full group)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def prices_renamed(raw: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Renamed and try-cast raw bars, before validation."""
    return raw.select(
        F.upper(F.trim("ticker")).alias("ticker"),
        F.col("date").try_cast("date").alias("price_date"),
        F.col("open").try_cast("double").alias("open_price"),
        F.col("high").try_cast("double").alias("high_price"),
        F.col("low").try_cast("double").alias("low_price"),
        F.col("close").try_cast("double").alias("close_price"),
        to_bigint(raw, "volume").alias("volume"),
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"),
        *carried,
    )


def price_derived() -> dict[str, Column]:
    """Columns of a staged bar that follow from its others."""
    change = F.col("close_price") - F.col("open_price")
    return {"stock_price_id": surrogate_key("ticker", "price_date"),
            "price_change": F.round(change, 4),
            "pct_change_open_to_close": F.round(safe_divide(change, "open_price") * 100, 4)}


def stg_prices(raw: DataFrame, as_of=None, carried: tuple[str, ...] = ()) -> DataFrame:
    """Clean, cast and validate raw daily bars; key them and derive the open-to-close change.  Columns
    of ``raw`` that are ``carried`` are appended."""
    v = prices_renamed(raw, carried).filter(valid_prices())
    more = price_derived()
    return v.select(
        more["stock_price_id"].alias("stock_price_id"),
        "ticker", "price_date", "open_price", "high_price", "low_price", "close_price", "volume",
        more["price_change"].alias("price_change"),
        more["pct_change_open_to_close"].alias("pct_change_open_to_close"),
        "ingested_at",
        updated_at(as_of).alias("dbt_updated_at"),
        *carried,
    )


def company_order() -> list[Column]:
    """Winner per ticker: highest market cap (nulls last), then latest load, then name."""
    return [F.col("market_cap_usd").desc_nulls_last(), F.col("ingested_at").desc_nulls_last(),
            F.col("company_name").asc_nulls_last()]


def companies_renamed(raw: DataFrame) -> DataFrame:
    """Normalised company records, before validation and de-duplication."""
    return raw.select(
        F.upper(F.trim("ticker")).alias("ticker"),
        F.trim("company_name").alias("company_name"),
        initcap_words(F.trim("sector")).alias("sector"),
        initcap_words(F.trim("industry")).alias("industry"),
        F.upper(F.trim("country")).alias("country"),
        F.upper(F.trim("exchange")).alias("exchange"),
        F.upper(F.trim("currency")).alias("currency"),
        F.col("market_cap").cast("double").alias("market_cap_usd"),
        to_bigint(raw, "full_time_employees").alias("full_time_employees"),
        F.nullif(F.trim("website"), F.lit("")).alias("website"),
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"),
    )


def companies_dedup(raw: DataFrame) -> DataFrame:
    return dedup_top1(companies_renamed(raw).filter(valid_companies()), ["ticker"],
                      company_order())


def stg_companies(raw: DataFrame, as_of=None) -> DataFrame:
    """Normalise casing, nullify blank websites, validate, keep one record per ticker."""
    d = companies_dedup(raw)
    return d.select(
        surrogate_key("ticker").alias("company_id"),
        "ticker", "company_name", "sector", "industry", "country", "exchange", "currency",
        "market_cap_usd",
        cap_category("market_cap_usd").alias("market_cap_category"),
        "full_time_employees", "website", "ingested_at",
        updated_at(as_of).alias("dbt_updated_at"),
    )


# --------------------------------------------------------------------------------------------
# Extract shaping (the loaders' in-memory steps, as DataFrame jobs)
# --------------------------------------------------------------------------------------------
def stamp(df: DataFrame, ticker: str | None = None, loaded_at=None) -> DataFrame:
    """Lower-case the column names; stamp a ticker (if given) and the load time."""
    out = df.toDF(*[c.strip().lower() for c in df.columns])
    cols = {}
    if ticker is not None:
        cols["ticker"] = F.lit(ticker)
    cols["ingested_at"] = (F.localtimestamp() if loaded_at is None
                           else F.lit(loaded_at).cast("timestamp_ntz"))
    return out.withColumns(cols)


def combine_extracts(dfs: list[DataFrame]) -> DataFrame:
    """Bag union of per-source extracts by column name.  Failed extracts are simply absent from
    ``dfs``; nothing at all arriving is an error."""
    if not dfs:
        raise ValueError("no extract arrived")
    return arrived(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs))


def arrived(df: DataFrame) -> DataFrame:
    """The same rows; an error if there is none (stops at the first row found)."""
    if df.isEmpty():
        raise ValueError("no rows arrived in any extract")
    return df


def restrict(df: DataFrame, universe, start=None, end=None, ticker_col: str = "ticker",
             date_col: str = "price_date") -> DataFrame:
    """Keep the ticker universe and the date range.  ``universe`` is a list of tickers or a
    one-column DataFrame (semi-joined; AQE broadcasts it when its measured size is small)."""
    out = df
    if start is not None:
        out = out.filter(F.col(date_col) >= F.lit(start).cast("date"))
    if end is not None:
        out = out.filter(F.col(date_col) <= F.lit(end).cast("date"))
    if isinstance(universe, DataFrame):
        u = universe.select(F.col(universe.columns[0]).alias(ticker_col))
        out = out.join(u, ticker_col, "left_semi")
    elif universe is not None:
        out = out.filter(F.col(ticker_col).isin(list(universe)))
    return out
