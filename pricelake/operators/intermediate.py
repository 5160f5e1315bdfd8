"""Intermediate jobs: prices joined to companies, returns, moving averages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pricelake.operators import series
from pricelake.operators.series import COMPANY_COLUMNS
from pricelake.operators.staging import price_derived

JOINED_COLUMNS = [
    "stock_price_id", "ticker", "price_date", "open_price", "high_price", "low_price",
    "close_price", "volume", "price_change", "pct_change_open_to_close",
    *COMPANY_COLUMNS, "ingested_at", "dbt_updated_at",
]


def attach_companies(prices: DataFrame, companies: DataFrame) -> DataFrame:
    """Left join price rows to the one-row-per-ticker company table on ``ticker``.

    No broadcast hint: the company side is the output of a de-duplication, whose size the
    planner cannot see statically; with AQE the join becomes a broadcast hash join once the
    measured size of that side is under the adaptive threshold, and stays a (skew-split)
    sort-merge join when it is not."""
    return prices.join(company_columns(companies), "ticker", "left")


def company_columns(companies: DataFrame) -> DataFrame:
    """What a price row gets of its company.  The series pass attaches it by (ticker, chunk)."""
    return companies.select("ticker", *[x for x in COMPANY_COLUMNS if x in companies.columns])


def prices_joined(stg_p: DataFrame, stg_c: DataFrame) -> DataFrame:
    """Prices with company attributes (22 columns; ``website`` is not carried)."""
    out = attach_companies(stg_p, stg_c)
    return out.select(*[c for c in JOINED_COLUMNS if c in out.columns])


# The series are computed on the narrow price columns and the companies are attached once, after
# them: a company column never takes part in a window, and the side table of the series needs none.
def daily_returns(stg_p: DataFrame, stg_c: DataFrame, **series_opts) -> DataFrame:
    """Joined prices with previous close, returns, intraday range and sequence (27 columns)."""
    out = series.daily_returns(stg_p, attach=company_columns(stg_c), derived=price_derived(), **series_opts)
    return out.select(*series.RETURNS_COLUMNS)


def moving_averages(stg_p: DataFrame, stg_c: DataFrame, **series_opts) -> DataFrame:
    """Daily returns with moving averages, cumulative mean and signal (34 columns)."""
    out = series.moving_averages(stg_p, attach=company_columns(stg_c), derived=price_derived(), **series_opts)
    return out.select(*series.MOVING_AVERAGE_COLUMNS)
