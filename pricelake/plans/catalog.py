"""Registered queries: name -> (Spark job over the driver tables, DuckDB oracle SQL or None).

Every query reads the driver's tables at ``sf_dir`` (or data Spark derives from them) over the
whole tables.  The volatile audit column ``dbt_updated_at`` is left out of compared outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators import (
    incremental,
    intermediate,
    joblog,
    marts,
    quality,
    readmodels,
    series,
    staging,
)
from pricelake.plans import oracle_sql as O
from pricelake.plans import layers, monthly, warehouse
from pricelake.plans.warehouse import Warehouse
from pricelake.session import scratch_path
from pricelake.sources import files, manifest
from pricelake.streaming import file_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _no_audit(df: DataFrame) -> DataFrame:
    return df.drop("dbt_updated_at")


# --------------------------------------------------------------------------------------------
# Shared builders
# --------------------------------------------------------------------------------------------
def raw(spark, sf, name):
    """A RAW table, landed once per session from the driver tables (see plans.warehouse)."""
    return Warehouse.of(spark, sf).raw(name)


def stg_p(spark, sf):
    return staging.stg_prices(raw(spark, sf, "raw_stock_prices"))


def stg_c(spark, sf):
    return staging.stg_companies(raw(spark, sf, "raw_company_metadata"))


def fct(spark, sf):
    """The fact table computed from RAW (the build itself)."""
    return marts.fct_prices(stg_p(spark, sf), stg_c(spark, sf))


def fct_mart(spark, sf, months=None):
    """The published fact table (or some of its months), as the tests and read queries see it."""
    return Warehouse.of(spark, sf).mart("fct_stock_prices", months)


def dim_mart(spark, sf):
    return Warehouse.of(spark, sf).mart("dim_companies")


# --------------------------------------------------------------------------------------------
# Models
# --------------------------------------------------------------------------------------------
@register("stg_prices", O.with_ctes("select * from stg_prices", "stg_prices"))
def q_stg_prices(spark, sf):
    return _no_audit(stg_p(spark, sf))


@register("stg_companies", O.with_ctes("select * from stg_companies", "stg_companies"))
def q_stg_companies(spark, sf):
    return _no_audit(stg_c(spark, sf))


@register("prices_joined", O.with_ctes("select * from prices_joined", "prices_joined"))
def q_prices_joined(spark, sf):
    return _no_audit(intermediate.prices_joined(stg_p(spark, sf), stg_c(spark, sf)))


@register("daily_returns", O.with_ctes("select * from daily_returns", "daily_returns"))
def q_daily_returns(spark, sf):
    return _no_audit(intermediate.daily_returns(stg_p(spark, sf), stg_c(spark, sf)))


@register("moving_averages", O.with_ctes("select * from moving_averages", "moving_averages"))
def q_moving_averages(spark, sf):
    return _no_audit(intermediate.moving_averages(stg_p(spark, sf), stg_c(spark, sf)))


@register("fct_prices", O.with_ctes("select * from fct_prices", "fct_prices"))
def q_fct_prices(spark, sf):
    return _no_audit(fct(spark, sf))


@register("dim_companies", O.with_ctes("select * from dim_companies", "dim_companies"))
def q_dim_companies(spark, sf):
    return _no_audit(marts.dim_companies(stg_c(spark, sf)))


# --------------------------------------------------------------------------------------------
# Operator-level queries on the same data
# --------------------------------------------------------------------------------------------
@register("dedup_top1", O.with_ctes(
    "select ticker, company_name, market_cap_usd, ingested_at from company_dedup",
    "company_dedup"))
def q_dedup_top1(spark, sf):
    return staging.companies_dedup(raw(spark, sf, "raw_company_metadata")).select(
        "ticker", "company_name", "market_cap_usd", "ingested_at")


@register("market_cap_category", O.with_ctes(
    "select market_cap_category, count(*) as companies, sum(market_cap_usd) as total_market_cap"
    " from stg_companies group by market_cap_category", "stg_companies"))
def q_market_cap_category(spark, sf):
    return stg_c(spark, sf).groupBy("market_cap_category").agg(
        F.count(F.lit(1)).alias("companies"), F.sum("market_cap_usd").alias("total_market_cap"))


@register("price_signal", O.with_ctes(
    "select ticker, price_vs_sma_30d, count(*) as trading_days from moving_averages"
    " group by ticker, price_vs_sma_30d", "moving_averages"))
def q_price_signal(spark, sf):
    return fct_mart(spark, sf).groupBy("ticker", "price_vs_sma_30d").agg(
        F.count(F.lit(1)).alias("trading_days"))


@register("cumulative_return", O.with_ctes(
    "select ticker, price_date, trading_day_seq, daily_return_pct, cumulative_avg_return_pct,"
    " sma_7d, sma_30d, sma_90d, vol_ma_7d, vol_ma_30d from moving_averages", "moving_averages"))
def q_cumulative_return(spark, sf):
    return series.series_metrics(stg_p(spark, sf)).select(
        "ticker", "price_date", "trading_day_seq", "daily_return_pct",
        "cumulative_avg_return_pct", "sma_7d", "sma_30d", "sma_90d", "vol_ma_7d", "vol_ma_30d")


def adjusted_derived() -> dict[str, Column]:
    """Columns of an adjusted bar that follow from its others."""
    move = F.col("close_price") - F.col("open_price")
    return {**staging.price_derived(), "price_change": F.round(move, 4),
            "pct_change_open_to_close": F.round(move / F.col("open_price") * 100, 4)}


def adjusted(prices: DataFrame) -> DataFrame:
    """Staged prices as a source that adjusts for splits and dividends gives them: divided by a
    factor that moves every day, so they carry all the decimals of a double."""
    f = F.lit(1) + F.datediff("price_date", F.lit("1990-01-01")) / F.lit(3652.5)
    out = prices.withColumns({c: F.col(c) / f for c in ("open_price", "high_price", "low_price", "close_price")})
    return out.withColumns(adjusted_derived())


@register("adjusted_moving_averages", O.with_ctes(
    "select * from adjusted_moving_averages", "adjusted_moving_averages"))
def q_adjusted_moving_averages(spark, sf):
    return _no_audit(series.series_metrics(adjusted(stg_p(spark, sf)), derived=adjusted_derived()))


@register("event_moving_averages", O.with_ctes(
    "select * from event_moving_averages", "event_moving_averages"))
def q_event_moving_averages(spark, sf):
    return _no_audit(series.series_metrics(staging.stg_prices(raw(spark, sf, "raw_event_prices")),
                                            derived=staging.price_derived()))


# --------------------------------------------------------------------------------------------
# Incremental publication
# --------------------------------------------------------------------------------------------
CUT = "2000-01-01 00:00:00"
OVERLAP_FROM = "1999-07-01 00:00:00"


def _published_until(spark, sf, name: str, until) -> manifest.Manifest:
    """The fact table built from the staged rows that ``until`` keeps, with the state of its series;
    written once per session."""
    w = Warehouse.of(spark, sf)
    path = files.layer_path(w.root, "DERIVED", name)

    def build(_):
        early = stg_p(spark, sf).filter(until)
        batch, _ = incremental.fct_increment(early, stg_c(spark, sf), None, keep_state=lambda df: files.stored(df, f"{path}-state"))
        layers.publish(batch, path, marts.FCT_CLUSTER, derived=marts.fct_derived())
    w.once(name, build)
    return manifest.at(spark, path, 1)


def _merged(spark, sf, table: manifest.Manifest) -> DataFrame:
    """The table after an incremental run over all staged rows on that version, as a table of its own."""
    out = scratch_path(spark, "increment")
    batch, _ = incremental.fct_increment(
        stg_p(spark, sf), stg_c(spark, sf), manifest.read(spark, table), spark.read.parquet(f"{table.root}-state"),
        keep=lambda df: files.stored(df, f"{out}-new", staging.price_derived()), history=warehouse.staged_history(spark, table),
        keep_part=lambda name, df: files.stored(df, f"{out}-{name}", warehouse.part_derived(name)))
    own = manifest.Manifest(out, 0, {m: [f"{table.root}/{f}" for f in fs] for m, fs in table.parts.items()}, table.schema)
    found = layers.merge(spark, own, files.stored(batch, f"{out}-batch", marts.fct_derived()), marts.FCT_KEY,
                         marts.FCT_CLUSTER, derived=marts.fct_derived(), parts=marts.FCT_PARTS)
    return _no_audit(manifest.read(spark, found))


def initial_version(spark, sf) -> manifest.Manifest:
    """Fact table as first published from the rows loaded up to CUT."""
    return _published_until(spark, sf, "fct_initial_cut",
                            F.col("ingested_at") <= F.lit(CUT).cast("timestamp_ntz"))


def initial_target(spark, sf) -> DataFrame:
    return manifest.read(spark, initial_version(spark, sf))


def before_last_day(spark, sf) -> manifest.Manifest:
    """Fact table as published before the last load."""
    last = stg_p(spark, sf).agg(F.max("ingested_at")).collect()[0][0]
    return _published_until(spark, sf, "fct_before_last_day", F.col("ingested_at") < F.lit(last))


@register("new_staged_prices", O.with_ctes(
    "select * from stg_prices where ingested_at > (select max(ingested_at) from stg_prices"
    f" where ingested_at <= timestamp '{CUT}')", "stg_prices"))
def q_new_staged_prices(spark, sf):
    """What an increment reads: the watermark is pushed into the scan of RAW."""
    return _no_audit(incremental.new_rows(stg_p(spark, sf), initial_target(spark, sf)))


@register("hwm_filter", O.with_ctes(
    "select * from fct_prices where ingested_at > (select max(ingested_at) from stg_prices"
    f" where ingested_at <= timestamp '{CUT}')", "fct_prices", "stg_prices"))
def q_hwm_filter(spark, sf):
    return _no_audit(incremental.new_rows(fct(spark, sf), initial_target(spark, sf)))


@register("fct_incremental", O.with_ctes("select * from fct_prices", "fct_prices"))
def q_fct_incremental(spark, sf):
    return _merged(spark, sf, initial_version(spark, sf))


@register("fct_one_day", O.with_ctes("select * from fct_prices", "fct_prices"))
def q_fct_one_day(spark, sf):
    """The usual increment: one more day for every ticker."""
    return _merged(spark, sf, before_last_day(spark, sf))


def _overlap(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The first publication, and a batch that also holds rows of it: stored, as it is read several times."""
    newer = F.col("ingested_at") > F.lit(OVERLAP_FROM).cast("timestamp_ntz")
    batch = fct(spark, sf).filter(newer).withColumn("from_batch", F.lit(True))
    return (initial_target(spark, sf).withColumn("from_batch", F.lit(False)),
            files.stored(batch, scratch_path(spark, "overlap"), marts.fct_derived()))


@register("upsert", O.with_ctes(
    f"select *, ingested_at > timestamp '{OVERLAP_FROM}' as from_batch from fct_prices",
    "fct_prices"))
def q_upsert(spark, sf):
    target, batch = _overlap(spark, sf)
    return _no_audit(incremental.upsert(target, batch, marts.FCT_KEY, follows="price_date", parts=marts.FCT_PARTS,
                                        derived=marts.fct_derived()))


@register("upsert_duplicates", O.with_ctes(
    "select * replace (case when from_batch and day_of_week = 1 then volume + 1000 else volume end as"
    " volume, case when from_batch and day_of_week = 1 then ingested_at + interval 1 hour else"
    f" ingested_at end as ingested_at) from (select *, ingested_at > timestamp '{OVERLAP_FROM}' as"
    " from_batch from fct_prices) f", "fct_prices"))
def q_upsert_duplicates(spark, sf):
    """A batch that holds every key twice or more: stale deliveries, and later corrections of the
    Mondays.  The latest load of each key is merged."""
    target, batch = _overlap(spark, sf)
    hour = F.expr("interval 1 hour")
    stale = batch.withColumns({"ingested_at": F.col("ingested_at") - hour, "volume": F.lit(-1).cast("bigint")})
    fixed = (batch.filter("day_of_week = 1")
             .withColumns({"ingested_at": F.col("ingested_at") + hour, "volume": F.col("volume") + 1000}))
    every = stale.unionByName(batch).unionByName(fixed).unionByName(batch)
    return _no_audit(incremental.upsert(
        target, incremental.latest_per_key(every, marts.FCT_KEY, ["ingested_at"], marts.FCT_PARTS, marts.fct_order_free()),
        marts.FCT_KEY, batch_keys=every.select(*marts.FCT_PARTS), follows="price_date", parts=marts.FCT_PARTS,
        derived=marts.fct_derived()))


# --------------------------------------------------------------------------------------------
# Extracts, universe, files
# --------------------------------------------------------------------------------------------
_STG_UNION = {"stg_union": (O._stg_prices(
    "(select * from raw_prices union all select * from event_prices)"),
    ["raw_prices", "event_prices"])}


def _stg_union(spark, sf):
    arrived = staging.combine_extracts([raw(spark, sf, "raw_stock_prices"),
                                        raw(spark, sf, "raw_event_prices")])
    return staging.stg_prices(arrived)


@register("union_extracts", O.with_ctes("select * from stg_union", "stg_union", extra=_STG_UNION))
def q_union_extracts(spark, sf):
    return _no_audit(_stg_union(spark, sf))


UNIVERSE_START, UNIVERSE_END = "1996-01-01", "2000-12-31"


@register("restrict_universe", O.with_ctes(
    "select * from stg_union where ticker in (select ticker from stg_companies)"
    f" and price_date between date '{UNIVERSE_START}' and date '{UNIVERSE_END}'",
    "stg_union", "stg_companies", extra=_STG_UNION))
def q_restrict_universe(spark, sf):
    out = staging.restrict(_stg_union(spark, sf), stg_c(spark, sf).select("ticker"),
                           UNIVERSE_START, UNIVERSE_END)
    return _no_audit(out)


def _csv_landing(spark, sf):
    """Raw prices written as CSV with the columns in another order than the table declares."""
    path = scratch_path(spark, "raw-prices-csv")
    prices = Warehouse.of(spark, sf).stage("raw_stock_prices")      # the text extract
    files.write_csv(prices.select("close", "ticker", "volume", "low", "high", "open", "date",
                                  "ingested_at"), path)
    return files.read_raw_csv(spark, path, list(files.RAW_PRICE_TYPES))


@register("csv_roundtrip", O.with_ctes("select * from stg_prices", "stg_prices"))
def q_csv_roundtrip(spark, sf):
    good, _ = files.split_rejects(_csv_landing(spark, sf), files.RAW_PRICE_TYPES)
    return _no_audit(staging.stg_prices(good))


def _reject_flags() -> str:
    """SQL: comma-joined names of the columns whose text does not cast ('' = loadable row)."""
    checks = []
    for c, t in files.RAW_PRICE_TYPES.items():
        if t == "string":
            continue
        cast = (f"try_cast(round(try_cast({c} as double)) as bigint)" if t == "bigint"
                else f"try_cast({c} as {'timestamp' if t == 'timestamp_ntz' else t})")
        checks.append(f"case when {c} is not null and {cast} is null then '{c}' end")
    return f"concat_ws(',', {', '.join(checks)})"


def _reject_sql() -> str:
    flags = _reject_flags()[len("concat_ws(',', "):-1]
    return O.with_ctes(
        f"select date, open, high, low, close, volume, ticker, "
        f"cast(ingested_at as varchar) as ingested_at, concat_ws(',', {flags}) as reject_columns "
        f"from raw_prices where concat_ws(',', {flags}) <> ''", "raw_prices")


@register("csv_rejects", _reject_sql())
def q_csv_rejects(spark, sf):
    _, rejects = files.split_rejects(_csv_landing(spark, sf), files.RAW_PRICE_TYPES)
    return rejects.withColumn("ingested_at", F.regexp_replace(
        F.col("ingested_at").cast("timestamp_ntz").cast("string"), "T", " "))


@register("csv_mixed_headers", O.with_ctes("select * from stg_prices", "stg_prices"))
def q_csv_mixed_headers(spark, sf):
    """Two extracts whose columns come in other orders, read together."""
    path = scratch_path(spark, "prices-mixed-csv")
    prices = Warehouse.of(spark, sf).stage("raw_stock_prices")
    order = list(files.RAW_PRICE_TYPES)
    odd = F.coalesce(F.col("volume").try_cast("long"), F.lit(0)) % 2 == 1
    files.write_csv(prices.filter(odd).select(*order), f"{path}/a")
    files.write_csv(prices.filter(~odd).select(*reversed(order)), f"{path}/b")
    good, _ = files.split_rejects(files.read_raw_csv(spark, f"{path}/*", order), files.RAW_PRICE_TYPES)
    return _no_audit(staging.stg_prices(good))


def _malformed_landing(spark, sf):
    """Price extract as text lines of which some lack the last field and some have one too many."""
    path = scratch_path(spark, "prices-malformed-csv")
    prices = Warehouse.of(spark, sf).stage("raw_stock_prices")
    names = list(files.RAW_PRICE_TYPES)
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])
    rest = F.col("volume").cast("long") % 7
    line = (F.when(rest == 0, F.regexp_replace(line, ",[^,]*$", ""))
            .when(rest == 1, F.concat(line, F.lit(",more"))).otherwise(line))
    (prices.select(line.alias(",".join(names))).write.option("header", True).option("sep", "\t")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return files.split_rejects(files.read_raw_csv(spark, path, names), files.RAW_PRICE_TYPES)


_WHOLE = {"whole_lines": ("select * from raw_prices where cast(volume as bigint) % 7 > 1", ["raw_prices"]),
          "stg_whole": (O._stg_prices("whole_lines"), ["whole_lines"])}


@register("csv_malformed_rows", O.with_ctes("select * from stg_whole", "stg_whole", extra=_WHOLE))
def q_csv_malformed_rows(spark, sf):
    return _no_audit(staging.stg_prices(_malformed_landing(spark, sf)[0]))


@register("csv_malformed_rejects", O.with_ctes(
    "select ticker, count(*) as records from (select case when cast(volume as bigint) % 7 > 1 then"
    " upper(trim(ticker)) else '(record)' end as ticker from raw_prices where cast(volume as bigint) % 7"
    f" < 2 or {_reject_flags()} <> '') r group by ticker", "raw_prices"))
def q_csv_malformed_rejects(spark, sf):
    rejects = _malformed_landing(spark, sf)[1]
    width = F.split("reject_columns", ",")[0] == "record"
    return (rejects.select(F.when(width, "(record)").otherwise(F.upper(F.trim("ticker"))).alias("ticker"))
            .groupBy("ticker").agg(F.count(F.lit(1)).alias("records")))


@register("csv_companies", O.with_ctes("select * from stg_companies", "stg_companies"))
def q_csv_companies(spark, sf):
    """Company records through a CSV file into RAW, as the loader does it."""
    root = scratch_path(spark, "companies-csv")
    companies = raw(spark, sf, "raw_company_metadata")
    files.write_csv(companies.select(*[F.col(c).alias(c.upper()) for c in reversed(companies.columns)]),
                    f"{root}/landing")
    out = warehouse.load_company_csv(spark, f"{root}/landing", root)
    return _no_audit(staging.stg_companies(spark.read.parquet(out["raw_company_metadata"])))


@register("stamped_extract", O.with_ctes(
    "select 'ACME' as ticker, company_name, sector, country, timestamp '2024-03-01 00:00:00' as"
    " ingested_at from raw_companies", "raw_companies"))
def q_stamped_extract(spark, sf):
    """An extract with the loader's upper-case names, stamped with a ticker and a load time."""
    companies = raw(spark, sf, "raw_company_metadata")
    upper = companies.toDF(*[c.upper() for c in companies.columns])
    return staging.stamp(upper, "ACME", "2024-03-01 00:00:00").select(
        "ticker", "company_name", "sector", "country", "ingested_at")


@register("public_view", O.with_ctes(
    "select sector, count(*) as companies from dim_companies group by sector", "dim_companies"))
def q_public_view(spark, sf):
    """The dimension in the default layer, read through a view."""
    root = scratch_path(spark, "public")
    path = files.layer_path(root, None, "dim_companies")
    files.full_refresh(dim_mart(spark, sf), path)
    files.as_view(files.table(spark, path), "public_dim_companies")
    return spark.sql("select sector, count(*) as companies from public_dim_companies group by sector")


@register("json_companies", O.with_ctes("select * from stg_companies", "stg_companies"))
def q_json_companies(spark, sf):
    path = scratch_path(spark, "companies-json")
    companies = raw(spark, sf, "raw_company_metadata")
    # Upper-case field names like the loader's records; null fields are left out of the JSON
    # lines, so they come back as missing fields.
    companies.select(*[F.col(c).alias(c.upper()) for c in companies.columns]).write.mode("overwrite").json(path)
    return _no_audit(staging.stg_companies(files.read_company_records(spark, path)))


# --------------------------------------------------------------------------------------------
# Quality checks
# --------------------------------------------------------------------------------------------
AS_OF = "2024-01-31 00:00:00"
FUTURE_AS_OF = "1998-01-01"


@register("check_not_null", O.with_ctes(
    "select ticker, price_date from fct_prices where daily_return_pct is null", "fct_prices"))
def q_check_not_null(spark, sf):
    return quality.check_not_null(fct_mart(spark, sf), "daily_return_pct").select("ticker",
                                                                             "price_date")


@register("check_unique", O.with_ctes(
    "select ticker, count(*) as n_records from company_renamed where ticker is not null"
    " group by ticker having count(*) > 1", "company_renamed"))
def q_check_unique(spark, sf):
    return quality.check_unique(staging.companies_renamed(raw(spark, sf, "raw_company_metadata")), "ticker")


@register("check_accepted", O.with_ctes(
    "select ticker, sector from dim_companies where sector is not null and sector not in ("
    + ", ".join(f"'{s}'" for s in quality.ACCEPTED_SECTORS) + ")", "dim_companies"))
def q_check_accepted(spark, sf):
    dim = dim_mart(spark, sf)
    return quality.check_accepted(dim, "sector", quality.ACCEPTED_SECTORS).select("ticker",
                                                                                 "sector")


@register("check_return_bounds", O.with_ctes(
    "select ticker, price_date, daily_return_pct from fct_prices where daily_return_pct is not"
    " null and (daily_return_pct > 75 or daily_return_pct < -75)", "fct_prices"))
def q_check_return_bounds(spark, sf):
    return quality.check_return_bounds(fct_mart(spark, sf))


_RENAMED = {"prices_renamed": ("""
  select upper(trim(ticker)) as ticker, try_cast(date as date) as price_date,
    try_cast(open as double) as open_price, try_cast(high as double) as high_price,
    try_cast(low as double) as low_price, try_cast(close as double) as close_price,
    try_cast(volume as bigint) as volume, cast(ingested_at as timestamp) as ingested_at
  from raw_prices""", ["raw_prices"])}


@register("check_high_low", O.with_ctes(
    "select ticker, price_date, high_price, low_price from prices_renamed"
    " where high_price < low_price", "prices_renamed", extra=_RENAMED))
def q_check_high_low(spark, sf):
    # Run on the unvalidated bars: after staging the rule cannot fail.
    return quality.check_high_low(staging.prices_renamed(raw(spark, sf, "raw_stock_prices")))


@register("check_no_future", O.with_ctes(
    f"select ticker, price_date from fct_prices where price_date > date '{FUTURE_AS_OF}'",
    "fct_prices"))
def q_check_no_future(spark, sf):
    return quality.check_no_future(fct_mart(spark, sf), FUTURE_AS_OF)


@register("check_positive", O.with_ctes(
    "select ticker, price_date, open_price, high_price, low_price, close_price, volume"
    " from prices_renamed where open_price <= 0 or high_price <= 0 or low_price <= 0"
    " or close_price <= 0 or volume < 0", "prices_renamed", extra=_RENAMED))
def q_check_positive(spark, sf):
    return quality.check_positive(staging.prices_renamed(raw(spark, sf, "raw_stock_prices")))


@register("check_sma_warm", O.with_ctes(
    "select ticker, price_date, sma_7d, sma_30d, sma_90d from (select * replace (case when"
    " day_of_week <> 2 then sma_90d end as sma_90d) from fct_prices) f where"
    " trading_day_seq > 90 and (sma_7d is null or sma_30d is null or sma_90d is null)",
    "fct_prices"))
def q_check_sma_warm(spark, sf):
    # On a fact table that lost its Tuesdays' averages: the published one cannot fail the rule.
    broken = F.when(F.col("day_of_week") != 2, F.col("sma_90d"))
    return quality.check_sma_warm(fct_mart(spark, sf).withColumn("sma_90d", broken))


@register("check_expected", O.with_ctes(
    "select ticker from (select distinct upper(trim(ticker)) as ticker from"
    " (select ticker from raw_prices union all select ticker from event_prices) x) e"
    " where ticker not in (select ticker from fct_prices)",
    "raw_prices", "event_prices", "fct_prices"))
def q_check_expected(spark, sf):
    # Expected universe: every ticker that arrived in either extract, before validation.
    arrived = staging.combine_extracts([raw(spark, sf, "raw_stock_prices"),
                                      raw(spark, sf, "raw_event_prices")])
    expected = arrived.select(F.upper(F.trim("ticker")).alias("ticker")).distinct()
    return quality.check_expected(fct_mart(spark, sf), expected)


@register("check_referential", O.with_ctes(
    "select distinct f.ticker from stg_union f left join dim_companies d on f.ticker = d.ticker"
    " where d.ticker is null", "stg_union", "dim_companies", extra=_STG_UNION))
def q_check_referential(spark, sf):
    return quality.check_referential(_stg_union(spark, sf), dim_mart(spark, sf))


_MODEL_CTES = {
    "raw_stock_prices": "typed_prices", "raw_company_metadata": "raw_companies",
    "stg_stock_prices": "stg_prices", "stg_company_metadata": "stg_companies",
    "int_stock_prices_joined": "prices_joined", "int_stock_daily_returns": "daily_returns",
    "int_stock_moving_averages": "moving_averages", "fct_stock_prices": "fct_prices",
    "dim_companies": "dim_companies",
}


def _summary_sql(*models: str) -> str:
    parts = []
    for model, src in _MODEL_CTES.items():
        if models and model not in models:
            continue
        for rule, col in quality.rule_list(model):
            if col == "dbt_updated_at":
                cond = "false"
            elif rule == "not_null":
                cond = f"{col} is null"
            elif rule == "accepted_values":
                vals = ", ".join(f"'{v}'" for v in quality.MODEL_TESTS[model]["accepted"][col])
                cond = f"{col} is not null and {col} not in ({vals})"
            else:
                cond = {
                    "daily_return_within_bounds":
                        "daily_return_pct is not null and (daily_return_pct > 75 or"
                        " daily_return_pct < -75)",
                    "high_price_gte_low_price": "high_price < low_price",
                    "no_future_dates": f"price_date > cast(timestamp '{AS_OF}' as date)",
                    "positive_prices": "open_price <= 0 or high_price <= 0 or low_price <= 0"
                                       " or close_price <= 0 or volume < 0",
                    "sma_not_null_after_warm_up":
                        "trading_day_seq > 90 and (sma_7d is null or sma_30d is null"
                        " or sma_90d is null)",
                }[rule]
            parts.append(f"select '{model}' as model, '{rule}' as rule, '{col}' as column_name,"
                         f" cast(count_if({cond}) as bigint) as failures from {src}")
        for col in quality.MODEL_TESTS[model]["unique"]:
            parts.append(f"select '{model}', 'unique', '{col}', cast(count(*) as bigint) from"
                         f" (select {col} from"
                         f" {src} where {col} is not null group by {col} having count(*) > 1) u")
    parts.append("select 'fct_stock_prices', 'fct_dim_referential_integrity', 'ticker',"
                 " cast(count(*) as bigint)"
                 " from (select distinct f.ticker from fct_prices f left join dim_companies d"
                 " on f.ticker = d.ticker where d.ticker is null) r")
    parts.append("select 'fct_stock_prices', 'all_tickers_present', 'ticker', cast(count(*) as bigint)"
                 f" from ({_EXPECTED_SQL}) e")
    typed = {"typed_prices": (f"select * from raw_prices where {_reject_flags()} = ''", ["raw_prices"])}
    ctes = [c for m, c in _MODEL_CTES.items() if not models or m in (*models, "dim_companies")]
    return O.with_ctes(" union all ".join(parts), *ctes, extra=typed)


# An expected universe that partly exists: fixed tickers, and the first suppliers.
EXPECTED = [*quality.EXPECTED_TICKERS, *(f"SUPPLIER#{i:09d}" for i in range(0, 60, 3))]
_EXPECTED_SQL = ("select ticker from (values " + ", ".join(f"('{t}')" for t in EXPECTED)
                 + ") v(ticker) where ticker not in (select ticker from fct_prices)")


@register("quality_summary", _summary_sql())
def q_quality_summary(spark, sf):
    """Every declared test of every layer, one row each."""
    w = Warehouse.of(spark, sf)
    w.publish()
    return warehouse.run_tests(spark, w.root, AS_OF, EXPECTED)


@register("fact_tests_by_month", _summary_sql("fct_stock_prices"))
def q_fact_tests_by_month(spark, sf):
    """The fact table's tests as sums of the months' stored counts."""
    w = Warehouse.of(spark, sf)
    w.publish()
    return warehouse.fact_tests(spark, w.root, AS_OF, EXPECTED)


# --------------------------------------------------------------------------------------------
# Job-log analyses
# --------------------------------------------------------------------------------------------
WAREHOUSE = "WH_0"
_RECENT = (f"start_time >= timestamp '{AS_OF}' - interval 7 day and warehouse_name ="
           f" '{WAREHOUSE}'")
_SECS = "round(total_elapsed_time / 1000, 2)"
_MBS = "round(bytes_scanned / 1024 / 1024, 2)"
_PRUNE = "round((1 - partitions_scanned / nullif(partitions_total, 0)) * 100, 2)"


def exact2(x: str) -> str:
    u = f"sum(cast(round({x} * 100) as hugeint))"
    n = f"count({x})"
    return (f"case when {n} > 0 then cast(sign({u}) * ((2 * abs({u}) + {n}) // (2 * {n}))"
            f" as double) / 100 end")


@register("recent_queries", O.with_ctes(
    "select query_id, query_text, database_name, schema_name, query_type, warehouse_name,"
    f" execution_status, start_time, end_time, {_SECS} as execution_time_secs,"
    f" {_MBS} as mb_scanned,"
    " round(bytes_spilled_to_local_storage / 1024 / 1024, 2) as mb_spilled_to_disk,"
    f" partitions_scanned, partitions_total, {_PRUNE} as partition_pruning_pct,"
    f" credits_used_cloud_services from job_log where {_RECENT}"
    " and execution_status = 'SUCCESS' order by start_time desc, query_id desc limit 100",
    "job_log"))
def q_recent_queries(spark, sf):
    return joblog.recent_queries(raw(spark, sf, "query_history"), AS_OF, WAREHOUSE)


@register("refresh_comparison", O.with_ctes(
    "select run_type, count(*) as total_queries,"
    f" {exact2('execution_time_secs')} as avg_execution_secs,"
    f" {exact2('mb_scanned')} as avg_mb_scanned, {exact2('partition_pruning_pct')} as avg_pruning_pct"
    " from (select case when lower(query_text) like '%is_incremental%' or lower(query_text)"
    " like '%merge into%' then 'Incremental Run' else 'Full Refresh Run' end as run_type,"
    f" {_SECS} as execution_time_secs, {_MBS} as mb_scanned, {_PRUNE} as partition_pruning_pct"
    f" from job_log where {_RECENT} and execution_status = 'SUCCESS' and"
    " (lower(query_text) like '%fct_stock_prices%' or lower(query_text) like"
    " '%int_stock_moving_averages%')) t group by run_type order by run_type", "job_log"))
def q_refresh_comparison(spark, sf):
    return joblog.refresh_comparison(raw(spark, sf, "query_history"), AS_OF, WAREHOUSE)


@register("hourly_usage", O.with_ctes(
    "select date_trunc('hour', start_time) as hour, cast(sum(credits_used) as double) as"
    " credits_used, cast(sum(credits_used_compute) as double) as compute_credits,"
    " cast(sum(credits_used_cloud_services) as double) as cloud_service_credits"
    f" from metering where {_RECENT} group by 1 order by 1 desc", "metering"))
def q_hourly_usage(spark, sf):
    return joblog.hourly_usage(raw(spark, sf, "warehouse_metering_history"), AS_OF, WAREHOUSE)


@register("slowest", O.with_ctes(
    f"select query_id, left(query_text, 100) as query_preview, {_SECS} as execution_time_secs,"
    f" {_MBS} as mb_scanned, partitions_scanned, partitions_total,"
    f" {_PRUNE} as partition_pruning_pct from job_log where {_RECENT}"
    " and execution_status = 'SUCCESS' order by total_elapsed_time desc, query_id asc limit 10",
    "job_log"))
def q_slowest(spark, sf):
    return joblog.slowest(raw(spark, sf, "query_history"), AS_OF, WAREHOUSE)


@register("layout_report")
def q_layout_report(spark, sf):
    # How far the ranges of the published fact table's files overlap on its clustering keys.
    w = Warehouse.of(spark, sf)
    w.publish()
    table = manifest.current(spark, files.layer_path(w.root, warehouse.MARTS, warehouse.FCT))
    return joblog.layout_report(spark, table.folders(), marts.FCT_CLUSTER)


@register("file_overlaps", O.with_ctes(
    "select 'price_date, ticker' as clustering_key, count(*) as total_units, sum(n)::bigint as total_rows,"
    " max(depth)::bigint as max_depth, round(avg(depth), 4) as average_depth,"
    " round(2 * (sum(depth) - count(*)) / count(*), 4) as average_overlaps from ("
    "select a.industry, any_value(a.n) as n, count(*) filter (where (b.lo < a.lo or (b.lo = a.lo and"
    " b.industry <= a.industry)) and b.hi >= a.lo) as depth from ranges a, ranges b group by a.industry) d",
    "ranges", extra={"ranges": (
        "select coalesce(industry, '') as industry, count(*) as n, min({'d': price_date, 't': ticker}) as lo,"
        " max({'d': price_date, 't': ticker}) as hi from fct_prices group by 1", ["fct_prices"])}))
def q_file_overlaps(spark, sf):
    """The same report on folders whose ranges are known: one per industry, of as many files as its rows
    need, so that no task has a whole industry."""
    def build(path):
        (fct_mart(spark, sf).withColumn("part", F.coalesce("industry", F.lit("")))
         .write.option("compression", "zstd").partitionBy("part").parquet(path))
    w = Warehouse.of(spark, sf)
    w.derived("fct_by_industry", build)
    return joblog.layout_report(spark, [files.layer_path(w.root, "DERIVED", "fct_by_industry")], marts.FCT_CLUSTER,
                                joblog.FOLDER)


@register("table_inventory")
def q_table_inventory(spark, sf):
    w = Warehouse.of(spark, sf)
    w.publish()
    for name in warehouse.RAW_TABLES:
        w.raw(name)
    return joblog.table_inventory(spark, warehouse.inventory(spark, w.root))


# --------------------------------------------------------------------------------------------
# Read models on the fact table
# --------------------------------------------------------------------------------------------
@register("ohlcv_series", O.with_ctes(
    "select ticker, price_date, open_price, high_price, low_price, close_price, volume"
    " from fct_prices", "fct_prices"))
def q_ohlcv_series(spark, sf):
    return readmodels.ohlcv_series(fct_mart(spark, sf))


@register("sma_series", O.with_ctes(
    "select ticker, price_date, close_price, sma_7d, sma_30d, sma_90d from fct_prices",
    "fct_prices"))
def q_sma_series(spark, sf):
    return readmodels.sma_series(fct_mart(spark, sf))


@register("volume_series", O.with_ctes(
    "select ticker, price_date, volume, case when close_price >= open_price then 'Up'"
    " else 'Down' end as direction, vol_ma_7d, vol_ma_30d from fct_prices", "fct_prices"))
def q_volume_series(spark, sf):
    return readmodels.volume_series(fct_mart(spark, sf))


# The dashboard's reads: one ticker, a date range.
TICKER, SINCE, UNTIL = "SUPPLIER#000000003", "1995-06-01", "1997-03-31"
MONTHS = layers.months_between(SINCE, UNTIL)
_PICK = f" where ticker = '{TICKER}' and price_date between date '{SINCE}' and date '{UNTIL}'"


@register("ohlcv_of_ticker", O.with_ctes(
    "select ticker, price_date, open_price, high_price, low_price, close_price, volume"
    f" from fct_prices{_PICK}", "fct_prices"))
def q_ohlcv_of_ticker(spark, sf):
    return readmodels.ohlcv_series(fct_mart(spark, sf, MONTHS), TICKER, SINCE, UNTIL)


@register("sma_of_ticker", O.with_ctes(
    f"select ticker, price_date, close_price, sma_7d, sma_30d, sma_90d from fct_prices{_PICK}",
    "fct_prices"))
def q_sma_of_ticker(spark, sf):
    return readmodels.sma_series(fct_mart(spark, sf, MONTHS), TICKER, SINCE, UNTIL)


@register("volume_of_ticker", O.with_ctes(
    "select ticker, price_date, volume, case when close_price >= open_price then 'Up'"
    f" else 'Down' end as direction, vol_ma_7d, vol_ma_30d from fct_prices{_PICK}", "fct_prices"))
def q_volume_of_ticker(spark, sf):
    return readmodels.volume_series(fct_mart(spark, sf, MONTHS), TICKER, SINCE, UNTIL)


def _exact4_agg(x: str) -> str:
    return O.exact4(f"sum({O.units4(x)})", f"count({x})")


@register("returns_heatmap", O.with_ctes(
    f"select ticker, price_month, {_exact4_agg('daily_return_pct')} as avg_daily_return_pct,"
    " count(*) as trading_days from fct_prices group by ticker, price_month", "fct_prices"))
def q_returns_heatmap(spark, sf):
    return readmodels.returns_heatmap(fct_mart(spark, sf))


@register("sector_performance", O.with_ctes(
    f"select sector, {_exact4_agg('daily_return_pct')} as avg_daily_return_pct,"
    " count(distinct ticker) as tickers, cast(sum(volume) as bigint) as total_volume,"
    " count(*) as trading_days"
    " from fct_prices group by sector", "fct_prices"))
def q_sector_performance(spark, sf):
    return readmodels.sector_performance(fct_mart(spark, sf))


@register("risk_return", O.with_ctes(
    f"select ticker, {_exact4_agg('daily_return_pct')} as avg_daily_return_pct,"
    " case when n > 1 then round(sqrt(cast(n * s2 - s1 * s1 as double)"
    " / cast(n * (n - 1) as double)) / 10000, 4) end as stddev_daily_return_pct,"
    " n as return_days from (select ticker, daily_return_pct,"
    " count(daily_return_pct) over (partition by ticker) as n,"
    f" sum({O.units4('daily_return_pct')}) over (partition by ticker) as s1,"
    f" sum({O.units4('daily_return_pct')} * {O.units4('daily_return_pct')})"
    " over (partition by ticker) as s2 from fct_prices) x group by ticker, n, s1, s2",
    "fct_prices"))
def q_risk_return(spark, sf):
    return readmodels.risk_return(fct_mart(spark, sf))


def figures(spark, sf) -> DataFrame:
    """Monthly figures that are published with the fact table."""
    w = Warehouse.of(spark, sf)
    w.publish()
    return warehouse.follow_fact(spark, w.root)["fct_figures"]


@register("sector_performance_by_month", SQL["sector_performance"])
def q_sector_performance_by_month(spark, sf):
    """The same answer from the monthly figures: no fact row is read."""
    return monthly.sector_performance(figures(spark, sf))


@register("risk_return_by_month", SQL["risk_return"])
def q_risk_return_by_month(spark, sf):
    """The same answer from the monthly figures: no fact row is read."""
    return monthly.risk_return(figures(spark, sf))


@register("top10_30d", O.with_ctes(
    "select ticker, base_date, base_close, latest_date, latest_close, round(case when"
    " base_close = 0 or base_close is null then null else (latest_close - base_close)"
    " / base_close end * 100, 4) as return_30d_pct from (select l.ticker, b.price_date as"
    " base_date, b.close_price as base_close, l.price_date as latest_date, l.close_price as"
    " latest_close from (select * from fct_prices qualify trading_day_seq = max(trading_day_seq)"
    " over (partition by ticker)) l join fct_prices b on b.ticker = l.ticker and"
    " b.trading_day_seq = l.trading_day_seq - 30) p order by return_30d_pct desc nulls last,"
    " ticker limit 10", "fct_prices"))
def q_top10_30d(spark, sf):
    return readmodels.top10_30d(fct_mart(spark, sf))


@register("avg_volume_rank", O.with_ctes(
    "select ticker, case when count(volume) > 0 then cast(sign(sum(volume)) * ((2 *"
    " abs(cast(sum(volume) as hugeint)) * 100 + count(volume)) // (2 * count(volume))) as"
    " double) / 100 end as avg_volume from fct_prices group by ticker"
    " order by avg_volume desc nulls last, ticker limit 10", "fct_prices"))
def q_avg_volume_rank(spark, sf):
    return readmodels.avg_volume_rank(fct_mart(spark, sf))


@register("best_performer", O.with_ctes(
    "select ticker, first_date, last_date, first_close, last_close, round(case when"
    " first_close = 0 or first_close is null then null else (last_close - first_close)"
    " / first_close end * 100, 4) as growth_pct from (select ticker, min(price_date) as"
    " first_date, max(price_date) as last_date, arg_min(close_price, price_date) as first_close,"
    " arg_max(close_price, price_date) as last_close from fct_prices group by ticker) g"
    " order by growth_pct desc nulls last, ticker limit 10", "fct_prices"))
def q_best_performer(spark, sf):
    return readmodels.best_performer(fct_mart(spark, sf))


# --------------------------------------------------------------------------------------------
# Streaming: file arrivals drive the incremental build
# --------------------------------------------------------------------------------------------
@register("stream_incremental", O.with_ctes("select * from fct_prices", "fct_prices"))
def q_stream_incremental(spark, sf):
    work = scratch_path(spark, "stream")
    raw_dir = f"{work}/raw"
    companies = stg_c(spark, sf)
    prices = Warehouse.of(spark, sf).stage("raw_stock_prices")      # arriving text files
    c = F.lit(CUT).cast("timestamp_ntz")
    prices.filter(F.col("ingested_at") <= c).write.option("compression", "zstd").parquet(f"{raw_dir}/arrival=1")
    file_stream.run_available(spark, raw_dir, companies, work)          # first daily run
    prices.filter(F.col("ingested_at") > c).write.option("compression", "zstd").parquet(f"{raw_dir}/arrival=2")
    out = file_stream.run_available(spark, raw_dir, companies, work)    # next run: new files
    return _no_audit(out)


_CORRECTED = {"raw_prices": (
    "select * replace (case when day(cast(date as date)) = 15 then high else close end as close)"
    f" from ({O.CTE['raw_prices']}) o", ["supplier_bars"])}


@register("stream_redelivery", O.with_ctes("select * from fct_prices", "fct_prices", extra=_CORRECTED))
def q_stream_redelivery(spark, sf):
    """A second arrival that also brings old bars again: those of every 10th unchanged, those of
    every 15th corrected.  The latest delivery of a bar counts, and later windows follow it."""
    work = scratch_path(spark, "stream")
    raw_dir = f"{work}/raw"
    companies = stg_c(spark, sf)
    prices = Warehouse.of(spark, sf).stage("raw_stock_prices")
    day, seen = F.dayofmonth(F.to_date("date")), F.col("ingested_at") <= F.lit(CUT).cast("timestamp_ntz")
    fixed = prices.withColumn("close", F.when(day == 15, F.col("high")).otherwise(F.col("close")))
    prices.filter(seen).write.option("compression", "zstd").parquet(f"{raw_dir}/arrival=1")
    file_stream.run_available(spark, raw_dir, companies, work)
    fixed.filter(~seen | day.isin(10, 15)).write.option("compression", "zstd").parquet(f"{raw_dir}/arrival=2")
    return _no_audit(file_stream.run_available(spark, raw_dir, companies, work))


# --------------------------------------------------------------------------------------------
# Dimension, incremental (watermark + upsert on company_id)
# --------------------------------------------------------------------------------------------
DIM_CUT = "2024-01-15 00:00:00"


@register("dim_incremental", O.with_ctes(
    "select * from dim_companies", "dim_companies",
    extra={"raw_companies": (O.CTE["raw_companies"], ["company_base"])}))
def q_dim_incremental(spark, sf):
    """First load: the company records loaded up to DIM_CUT; then an incremental run over all
    records.  Later records that lose the de-duplication (lower or null market cap) never
    replace the published row, so the result equals a full rebuild."""
    companies = raw(spark, sf, "raw_company_metadata")
    first = staging.stg_companies(
        companies.filter(F.col("ingested_at") <= F.lit(DIM_CUT).cast("timestamp_ntz")))
    target = marts.dim_companies(first)
    return _no_audit(incremental.dim_incremental(stg_c(spark, sf), target))


@register("table_row_counts", O.with_ctes(
    " union all ".join(
        f"select '{layer}' as table_schema, '{name}' as table_name, count(*) as row_count"
        f" from {cte}{where}"
        for layer, name, cte, where in [
            ("RAW", "raw_stock_prices", "raw_prices", f" where {_reject_flags()} = ''"),
            ("RAW", "raw_stock_prices_rejects", "raw_prices", f" where {_reject_flags()} <> ''"),
            ("RAW", "raw_company_metadata", "raw_companies", ""),
            ("RAW", "raw_event_prices", "event_prices", f" where {_reject_flags()} = ''"),
            ("RAW", "raw_event_prices_rejects", "event_prices", f" where {_reject_flags()} <> ''"),
            ("RAW", "query_history", "job_log", ""),
            ("RAW", "warehouse_metering_history", "metering", ""),
            ("MARTS", "fct_stock_prices", "fct_prices", ""),
            ("MARTS", "dim_companies", "dim_companies", "")]),
    "raw_prices", "raw_companies", "event_prices", "job_log", "metering", "fct_prices",
    "dim_companies"))
def q_table_row_counts(spark, sf):
    """Row counts of every landed and published table, read from the written files (metadata
    column only) - the checkable part of the table inventory."""
    return (q_table_inventory(spark, sf).filter("row_count is not null")
            .select("table_schema", "table_name", "row_count"))


@register("check_expected_universe", O.with_ctes(_EXPECTED_SQL, "fct_prices"))
def q_check_expected_universe(spark, sf):
    """A fixed universe (an inline list) of which some tickers arrived, against the fact table."""
    return quality.check_expected(fct_mart(spark, sf), EXPECTED)
