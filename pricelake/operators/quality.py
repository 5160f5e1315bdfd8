"""Data-quality checks.  Each check returns the violating rows: empty means pass.

``quality_summary`` runs every row-level rule of one table in a single aggregate pass
(``count_if`` per rule, partial aggregation on every task, one row out), instead of one scan per
rule; only rules that fail need their rows fetched with the individual checks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.functions.scalar import CAP_CATEGORIES, SIGNALS, any_of, outside, packed, unpacked

# --------------------------------------------------------------------------------------------
# Declared column tests of the published models
# --------------------------------------------------------------------------------------------
ACCEPTED_SECTORS = [
    "Technology", "Financial Services", "Healthcare", "Energy", "Consumer Cyclical",
    "Consumer Defensive", "Communication Services", "Industrials", "Basic Materials",
    "Real Estate", "Utilities",
]
EXPECTED_TICKERS = [
    "AAPL", "MSFT", "NVDA", "GOOGL", "META",
    "JPM", "BAC", "GS", "V", "MA",
    "JNJ", "PFE", "UNH", "ABBV", "MRK",
    "XOM", "CVX", "COP", "SLB", "EOG",
    "AMZN", "TSLA", "HD", "MCD", "NKE",
]
RETURN_BOUND = 75.0
WARM_UP_ROWS = 90

MODEL_TESTS = {
    "raw_stock_prices": {
        "not_null": ["ticker", "date", "close", "volume"], "unique": [], "accepted": {},
    },
    "raw_company_metadata": {
        "not_null": ["ticker"], "unique": ["ticker"], "accepted": {},
    },
    "stg_stock_prices": {
        "not_null": ["stock_price_id", "ticker", "price_date", "open_price", "high_price",
                     "low_price", "close_price", "volume", "ingested_at", "dbt_updated_at"],
        "unique": ["stock_price_id"], "accepted": {},
    },
    "stg_company_metadata": {
        "not_null": ["company_id", "ticker", "company_name", "sector", "ingested_at",
                     "dbt_updated_at"],
        "unique": ["company_id", "ticker"],
        "accepted": {"market_cap_category": CAP_CATEGORIES},
    },
    "int_stock_prices_joined": {
        "not_null": ["stock_price_id", "ticker", "price_date", "open_price", "high_price",
                     "low_price", "close_price", "volume"],
        "unique": ["stock_price_id"], "accepted": {},
    },
    "int_stock_daily_returns": {
        "not_null": ["stock_price_id", "ticker", "price_date", "intraday_range",
                     "intraday_range_pct", "trading_day_seq"],
        "unique": ["stock_price_id"], "accepted": {},
    },
    "int_stock_moving_averages": {
        "not_null": ["stock_price_id", "ticker", "price_date", "sma_7d", "sma_30d", "sma_90d",
                     "vol_ma_7d", "vol_ma_30d", "price_vs_sma_30d"],
        "unique": ["stock_price_id"], "accepted": {"price_vs_sma_30d": SIGNALS},
    },
    "fct_stock_prices": {
        "not_null": ["stock_price_id", "ticker", "company_name", "sector", "market_cap_category",
                     "price_date", "price_week", "price_month", "price_year", "day_of_week",
                     "trading_day_seq", "open_price", "high_price", "low_price", "close_price",
                     "volume", "intraday_range", "intraday_range_pct", "sma_7d", "sma_30d",
                     "sma_90d", "vol_ma_7d", "vol_ma_30d", "price_vs_sma_30d", "ingested_at",
                     "dbt_updated_at"],
        "unique": ["stock_price_id"],
        "accepted": {"market_cap_category": CAP_CATEGORIES, "price_vs_sma_30d": SIGNALS},
    },
    "dim_companies": {
        "not_null": ["company_id", "ticker", "company_name", "sector", "country", "exchange",
                     "currency", "market_cap_category", "ingested_at", "dbt_updated_at"],
        "unique": ["company_id", "ticker"],
        "accepted": {"sector": ACCEPTED_SECTORS, "market_cap_category": CAP_CATEGORIES},
    },
}
# --------------------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Generic column tests ------------------------------------------------------------------------
def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Values that occur more than once (nulls ignored): ``(value, n_records)``.

    One shuffle.  A key that is unique gains nothing from partial aggregation, so texts are counted
    in packed form, in which a surrogate key takes half its bytes, and only values that occur again are
    unpacked."""
    text = isinstance(df.schema[col].dataType, T.StringType)
    value = packed(col) if text else F.col(col)
    again = (df.filter(F.col(col).isNotNull()).groupBy(value.alias("_v")).agg(F.count(F.lit(1)).alias("n_records"))
             .filter(F.col("n_records") > 1))
    return again.select((unpacked("_v") if text else F.col("_v")).alias(col), "n_records")


def check_accepted(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(values))


# Singular tests on the fact table -----------------------------------------------------------
def return_violation(lo: float = -RETURN_BOUND, hi: float = RETURN_BOUND) -> Column:
    return outside("daily_return_pct", lo, hi)


def check_return_bounds(fct: DataFrame, lo: float = -RETURN_BOUND,
                        hi: float = RETURN_BOUND) -> DataFrame:
    return fct.filter(return_violation(lo, hi)).select("ticker", "price_date", "daily_return_pct")


def high_low_violation() -> Column:
    return F.col("high_price") < F.col("low_price")


def check_high_low(fct: DataFrame) -> DataFrame:
    return fct.filter(high_low_violation()).select("ticker", "price_date", "high_price",
                                                   "low_price")


def future_violation(as_of=None) -> Column:
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return F.col("price_date") > today


def check_no_future(fct: DataFrame, as_of=None) -> DataFrame:
    return fct.filter(future_violation(as_of)).select("ticker", "price_date")


def positive_violation() -> Column:
    return any_of(*[F.col(c) <= 0 for c in ["open_price", "high_price", "low_price",
                                             "close_price"]], F.col("volume") < 0)


def check_positive(fct: DataFrame) -> DataFrame:
    return fct.filter(positive_violation()).select(
        "ticker", "price_date", "open_price", "high_price", "low_price", "close_price", "volume")


def sma_warm_violation(warm: int = WARM_UP_ROWS) -> Column:
    return (F.col("trading_day_seq") > warm) & any_of(
        *[F.col(c).isNull() for c in ["sma_7d", "sma_30d", "sma_90d"]])


def check_sma_warm(fct: DataFrame, warm: int = WARM_UP_ROWS) -> DataFrame:
    return fct.filter(sma_warm_violation(warm)).select("ticker", "price_date", "sma_7d",
                                                       "sma_30d", "sma_90d")


def check_expected(fct: DataFrame, expected) -> DataFrame:
    """Expected tickers missing from the fact table, with ``NOT IN`` semantics: one null ticker
    in the fact table makes the result empty.  ``expected`` is a one-column DataFrame or a list.
    The fact side is reduced to distinct tickers (partial aggregation) before the anti-join."""
    if not isinstance(expected, DataFrame):
        spark = fct.sparkSession
        expected = spark.createDataFrame([(t,) for t in expected], "ticker string")
    exp = expected.select(F.col(expected.columns[0]).alias("ticker"))
    actual = fct.select("ticker").distinct()
    n_actual = actual.agg(F.count(F.lit(1))).scalar()
    n_null = actual.agg(F.count_if(F.col("ticker").isNull())).scalar()
    return (exp.join(actual.filter(F.col("ticker").isNotNull()), "ticker", "left_anti")
            .filter((n_null == 0) & (F.col("ticker").isNotNull() | (n_actual == 0))))


def check_referential(fct: DataFrame, dim: DataFrame) -> DataFrame:
    """Distinct fact tickers without a dimension row (null tickers included)."""
    return (fct.select("ticker").distinct()
            .join(dim.select("ticker").distinct(), "ticker", "left_anti"))


# Fused pass --------------------------------------------------------------------------------
# Singular tests of the fact table: (rule, reported column).
FCT_SINGULAR = [
    ("daily_return_within_bounds", "daily_return_pct"),
    ("high_price_gte_low_price", "high_price"),
    ("no_future_dates", "price_date"),
    ("positive_prices", "close_price"),
    ("sma_not_null_after_warm_up", "sma_90d"),
]


def rule_list(model: str) -> list[tuple[str, str]]:
    """(rule, column) of every row-level test of ``model``, in summary order."""
    spec = MODEL_TESTS[model]
    rules = [("not_null", c) for c in spec["not_null"]]
    rules += [("accepted_values", c) for c in spec["accepted"]]
    if model == "fct_stock_prices":
        rules += FCT_SINGULAR
    return rules


def row_rules(model: str, as_of=None) -> list[tuple[str, str, Column]]:
    """(rule, column, violation predicate) for every row-level test of ``model``."""
    spec = MODEL_TESTS[model]
    singular = {
        "daily_return_within_bounds": return_violation,
        "high_price_gte_low_price": high_low_violation,
        "no_future_dates": lambda: future_violation(as_of),
        "positive_prices": positive_violation,
        "sma_not_null_after_warm_up": sma_warm_violation,
    }
    out = []
    for rule, c in rule_list(model):
        if rule == "not_null":
            out.append((rule, c, F.col(c).isNull()))
        elif rule == "accepted_values":
            out.append((rule, c, F.col(c).isNotNull() & ~F.col(c).isin(spec["accepted"][c])))
        else:
            out.append((rule, c, singular[rule]()))
    return out


def quality_summary(df: DataFrame, model: str | list[str], as_of=None) -> DataFrame:
    """One row per row-level rule: ``(model, rule, column_name, failures)`` from ONE scan.  Several
    models may be checked on one frame that has the rows and columns of them all."""
    models = [model] if isinstance(model, str) else model
    rules = [(m, r, c, p) for m in models for r, c, p in row_rules(m, as_of) if c in df.columns]
    counts = df.agg(*[F.count_if(p).alias(f"r{i}") for i, (_, _, _, p) in enumerate(rules)])
    rows = ", ".join(f"'{m}', '{r}', '{c}', r{i}" for i, (m, r, c, _) in enumerate(rules))
    return counts.selectExpr(f"stack({len(rules)}, {rows}) as (model, rule, column_name, failures)")


def _count(violations: DataFrame, model: str, rule: str, column: str) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(rule).alias("rule"),
        F.lit(column).alias("column_name"), "failures")


def uniqueness_summary(df: DataFrame, model: str) -> DataFrame | None:
    parts = [_count(check_unique(df, c), model, "unique", c)
             for c in MODEL_TESTS[model]["unique"] if c in df.columns]
    return reduce(DataFrame.unionByName, parts) if parts else None


#: Views that are one frame: the moving averages hold the rows and columns of all three.
SERIES_MODELS = ["int_stock_prices_joined", "int_stock_daily_returns", "int_stock_moving_averages"]


def run_all(spark: SparkSession, tables: dict[str, DataFrame], as_of=None,
            expected=None) -> DataFrame:
    """Summary of every declared test: per table one scan for its row rules, uniqueness, referential
    integrity and the expected tickers (``EXPECTED_TICKERS`` unless given).  ``tables`` maps model
    names to frames; models that are left out are not tested.

    The series views have exactly the rows and the key of staged prices (a bar is joined to one company
    at most), so their uniqueness is counted there, where the planner reuses one shuffle."""
    parts = []
    series, staged = tables.get("int_stock_moving_averages"), tables.get("stg_stock_prices")
    for model, df in tables.items():
        if model not in SERIES_MODELS:
            parts.append(quality_summary(df, model, as_of))
        parts.append(uniqueness_summary(df if model not in SERIES_MODELS or staged is None else staged, model))
    if series is not None:
        parts.append(quality_summary(series, [m for m in SERIES_MODELS if m in tables], as_of))
    fct, dim = tables.get("fct_stock_prices"), tables.get("dim_companies")
    if fct is not None and dim is not None:
        parts.append(_count(check_referential(fct, dim), "fct_stock_prices",
                            "fct_dim_referential_integrity", "ticker"))
    if fct is not None:
        wanted = EXPECTED_TICKERS if expected is None else expected
        parts.append(_count(check_expected(fct, wanted), "fct_stock_prices",
                            "all_tickers_present", "ticker"))
    return reduce(DataFrame.unionByName, [p for p in parts if p is not None])
