"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly in SQL over the driver's views (``lineitem``, ``supplier``, ``events``, ...), as
plain window functions over whole partitions, the way the reference models are written.  The
Spark jobs compute the same values with a different (blocked, skew-safe) plan, so agreement is a
real check.  Price averages sum the close in units of 1e-10 (never rounded to the output's four
decimals first).  Other exact averages use integer sums: for x with at most 4 decimals,
``u = sum(round(x * 10^4))`` and ``round(u / n)`` half away from zero is
``sign(u) * ((2|u| + n) // (2n))``.
"""

from __future__ import annotations

# Word delimiters for initcap (same fixed list as pricelake.functions.scalar).
_DELIMS = r"""[\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>]"""


def initcap_sql(expr: str) -> str:
    s = f"lower({expr})"
    return (f"case when {expr} is null then null else array_to_string(list_transform("
            f"range(1, length({s}) + 1), lambda i: case when i = 1 or regexp_matches("
            f"substr({s}, i - 1, 1), '{_DELIMS}') then upper(substr({s}, i, 1)) "
            f"else substr({s}, i, 1) end), '') end")


def exact4(u: str, n: str) -> str:
    return (f"case when {n} > 0 then cast(sign({u}) * ((2 * abs({u}) + {n}) // (2 * {n})) "
            f"as double) / 10000 end")


def units4(x: str) -> str:
    return f"cast(round({x} * 10000) as hugeint)"


def units10(x: str) -> str:
    return (f"(cast(floor({x}) as hugeint) * 10000000000"
            f" + cast(round(({x} - floor({x})) * 10000000000.0::double) as hugeint))")


def price_avg(u: str, n: str) -> str:
    return (f"case when {n} > 0 then cast((2 * {u} + {n} * 1000000::hugeint)"
            f" // (2 * {n} * 1000000::hugeint) as double) / 10000 end")


def safe_div(n: str, d: str) -> str:
    return f"case when ({d}) = 0 or ({d}) is null then null else ({n}) / ({d}) end"


def skey(*cols: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} as varchar), '_null_')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


CTE: dict[str, str] = {}

CTE["supplier_bars"] = """
  select l_suppkey, cast(l_shipdate as date) as d,
    first(l_extendedprice order by l_orderkey, l_linenumber, l_partkey, l_extendedprice) as o,
    max(l_extendedprice) as h, min(l_extendedprice) as l,
    last(l_extendedprice order by l_orderkey, l_linenumber, l_partkey, l_extendedprice) as c,
    cast(sum(l_quantity) as bigint) as v
  from lineitem group by 1, 2"""

CTE["raw_prices"] = """
  select cast(d as varchar) as date,
    case when m = 1 then '0' else cast(cast(o as decimal(18,2)) as varchar) end as open,
    cast(cast(case when m = 2 then l - 1 else h end as decimal(18,2)) as varchar) as high,
    cast(cast(l as decimal(18,2)) as varchar) as low,
    case when m = 3 then 'n/a' else cast(cast(c as decimal(18,2)) as varchar) end as close,
    cast(v as varchar) as volume,
    concat('  ', lower(s_name), ' ') as ticker,
    cast(d as timestamp) + interval 1 day as ingested_at
  from (select b.*, s_name, (l_suppkey * 31 + date_diff('day', date '1995-01-01', d)) % 50 as m
        from supplier_bars b join supplier on l_suppkey = s_suppkey) k"""

CTE["company_base"] = """
  select *, cast(round(s_acctbal * 100) as bigint) * 1000000 as cap
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""

CTE["raw_companies"] = """
  select concat(' ', lower(s_name)) as ticker, concat(s_name, ' Inc ') as company_name,
    lower(r_name) as sector, concat(lower(r_name), '/', lower(n_name)) as industry,
    lower(n_name) as country, 'nyq' as exchange, 'usd' as currency, cap as market_cap,
    s_suppkey * 10 as full_time_employees,
    case when s_suppkey % 5 = 0 then ' ' else concat('https://', lower(s_name), '.example') end
      as website,
    timestamp '2024-01-01 00:00:00' as ingested_at
  from company_base
  union all
  select lower(s_name), concat(s_name, ' Old'), lower(r_name), lower(r_name), lower(n_name),
    'nyq', 'usd', case when s_suppkey % 2 = 0 then null else cap - 1 end, null, null,
    timestamp '2024-02-01 00:00:00'
  from company_base where s_suppkey % 3 = 0"""

CTE["event_raw"] = """
  select concat('user_', cast(user_id as varchar)) as ticker, cast(ts as date) as d,
    cast(cast(first(value order by ts, event_id) as decimal(18,2)) as varchar) as open,
    cast(cast(max(value) as decimal(18,2)) as varchar) as high,
    cast(cast(min(value) as decimal(18,2)) as varchar) as low,
    cast(cast(last(value order by ts, event_id) as decimal(18,2)) as varchar) as close,
    cast(count(*) as varchar) as volume
  from events group by user_id, cast(ts as date)"""

CTE["event_prices"] = """
  select cast(d as varchar) as date, open, high, low, close, volume, ticker,
    cast(d as timestamp) + interval 1 day as ingested_at
  from event_raw"""


def _stg_prices(src: str) -> str:
    return f"""
  select {skey('ticker', 'price_date')} as stock_price_id,
    ticker, price_date, open_price, high_price, low_price, close_price, volume,
    round(close_price - open_price, 4) as price_change,
    round({safe_div('close_price - open_price', 'open_price')} * 100, 4) as pct_change_open_to_close,
    ingested_at
  from (select upper(trim(ticker)) as ticker, try_cast(date as date) as price_date,
          try_cast(open as double) as open_price, try_cast(high as double) as high_price,
          try_cast(low as double) as low_price, try_cast(close as double) as close_price,
          try_cast(volume as bigint) as volume, cast(ingested_at as timestamp) as ingested_at
        from {src}) r
  where ticker is not null and price_date is not null and close_price is not null
    and open_price is not null and high_price is not null and low_price is not null
    and close_price > 0 and open_price > 0 and high_price > 0 and low_price > 0
    and high_price >= low_price"""


CTE["stg_prices"] = _stg_prices("raw_prices")
CTE["stg_event_prices"] = _stg_prices("event_prices")

CTE["company_renamed"] = f"""
  select upper(trim(ticker)) as ticker, trim(company_name) as company_name,
    {initcap_sql('trim(sector)')} as sector, {initcap_sql('trim(industry)')} as industry,
    upper(trim(country)) as country, upper(trim(exchange)) as exchange,
    upper(trim(currency)) as currency, cast(market_cap as double) as market_cap_usd,
    cast(full_time_employees as bigint) as full_time_employees,
    nullif(trim(website), '') as website, cast(ingested_at as timestamp) as ingested_at
  from raw_companies"""

CTE["company_dedup"] = """
  select * from company_renamed
  where ticker is not null and trim(ticker) != '' and company_name is not null
  qualify row_number() over (partition by ticker order by market_cap_usd desc nulls last,
                             ingested_at desc nulls last, company_name asc nulls last) = 1"""

CTE["stg_companies"] = f"""
  select {skey('ticker')} as company_id, ticker, company_name, sector, industry, country,
    exchange, currency, market_cap_usd,
    case when market_cap_usd >= 200e9 then 'Mega Cap'
         when market_cap_usd >= 10e9 then 'Large Cap'
         when market_cap_usd >= 2e9 then 'Mid Cap'
         when market_cap_usd >= 300e6 then 'Small Cap'
         when market_cap_usd > 0 then 'Micro Cap'
         else 'Unknown' end as market_cap_category,
    full_time_employees, website, ingested_at
  from company_dedup"""

COMPANY_COLS = ("company_id, company_name, sector, industry, country, exchange, currency, "
                "market_cap_usd, market_cap_category, full_time_employees")

CTE["prices_joined"] = """
  select sp.stock_price_id, sp.ticker, sp.price_date, sp.open_price, sp.high_price,
    sp.low_price, sp.close_price, sp.volume, sp.price_change, sp.pct_change_open_to_close,
    cm.company_id, cm.company_name, cm.sector, cm.industry, cm.country, cm.exchange,
    cm.currency, cm.market_cap_usd, cm.market_cap_category, cm.full_time_employees,
    sp.ingested_at
  from stg_prices sp left join stg_companies cm on sp.ticker = cm.ticker"""


def _returns(src: str) -> str:
    lag = "lag(close_price) over w"
    return f"""
  select stock_price_id, ticker, price_date, open_price, high_price, low_price, close_price,
    {lag} as prev_close_price, volume, price_change, pct_change_open_to_close,
    round({safe_div(f'close_price - {lag}', lag)} * 100, 4) as daily_return_pct,
    round(high_price - low_price, 4) as intraday_range,
    round({safe_div('high_price - low_price', 'close_price')} * 100, 4) as intraday_range_pct,
    cast(row_number() over w as integer) as trading_day_seq,
    * exclude (stock_price_id, ticker, price_date, open_price, high_price, low_price,
               close_price, volume, price_change, pct_change_open_to_close)
  from {src}
  window w as (partition by ticker order by price_date)"""


# Closes as a source that adjusts for splits and dividends gives them: many decimals.
CTE["adjusted_prices"] = """
  select stock_price_id, ticker, price_date, open_price / f as open_price,
    high_price / f as high_price, low_price / f as low_price, close_price / f as close_price,
    volume, ingested_at,
    round(close_price / f - open_price / f, 4) as price_change,
    round((close_price / f - open_price / f) / (open_price / f) * 100, 4)
      as pct_change_open_to_close
  from (select *, 1 + date_diff('day', date '1990-01-01', price_date) / 3652.5::double as f
        from stg_prices) a"""
CTE["daily_returns"] = _returns("prices_joined")
CTE["adjusted_returns"] = _returns("adjusted_prices")
CTE["event_returns"] = _returns("stg_event_prices")


def _ma_units(src: str) -> str:
    def fr(n):
        return f"(partition by ticker order by price_date rows between {n - 1} preceding and current row)"
    return f"""
  select *,
    sum({units10('close_price')}) over {fr(7)} as u7, count(close_price) over {fr(7)} as n7,
    sum({units10('close_price')}) over {fr(30)} as u30, count(close_price) over {fr(30)} as n30,
    sum({units10('close_price')}) over {fr(90)} as u90, count(close_price) over {fr(90)} as n90,
    cast(round(avg(volume) over {fr(7)}, 0) as bigint) as vol_ma_7d,
    cast(round(avg(volume) over {fr(30)}, 0) as bigint) as vol_ma_30d,
    sum({units4('daily_return_pct')}) over (partition by ticker order by price_date
        rows between unbounded preceding and current row) as uc,
    count(daily_return_pct) over (partition by ticker order by price_date
        rows between unbounded preceding and current row) as nc
  from {src}"""


def _ma(src: str) -> str:
    return f"""
  select stock_price_id, ticker, price_date, trading_day_seq, open_price, high_price, low_price,
    close_price, prev_close_price, volume, price_change, pct_change_open_to_close,
    daily_return_pct, intraday_range, intraday_range_pct,
    {exact4('uc', 'nc')} as cumulative_avg_return_pct,
    {price_avg('u7', 'n7')} as sma_7d, {price_avg('u30', 'n30')} as sma_30d,
    {price_avg('u90', 'n90')} as sma_90d, vol_ma_7d, vol_ma_30d,
    case when close_price > {price_avg('u30', 'n30')} then 'Above 30d MA'
         when close_price < {price_avg('u30', 'n30')} then 'Below 30d MA'
         else 'At 30d MA' end as price_vs_sma_30d,
    * exclude (stock_price_id, ticker, price_date, trading_day_seq, open_price, high_price,
               low_price, close_price, prev_close_price, volume, price_change,
               pct_change_open_to_close, daily_return_pct, intraday_range, intraday_range_pct,
               u7, n7, u30, n30, u90, n90, vol_ma_7d, vol_ma_30d, uc, nc)
  from ({_ma_units(src)}) x"""


CTE["moving_averages"] = _ma("daily_returns")
CTE["adjusted_moving_averages"] = _ma("adjusted_returns")
CTE["event_moving_averages"] = _ma("event_returns")

FCT_SELECT = """
    stock_price_id, ticker, company_name, sector, industry, country, exchange, currency,
    market_cap_category, price_date,
    cast(date_trunc('week', price_date) as date) as price_week,
    cast(date_trunc('month', price_date) as date) as price_month,
    cast(date_trunc('year', price_date) as date) as price_year,
    cast(dayofweek(price_date) as integer) as day_of_week,
    trading_day_seq, open_price, high_price, low_price, close_price, prev_close_price, volume,
    price_change, pct_change_open_to_close, daily_return_pct, intraday_range, intraday_range_pct,
    cumulative_avg_return_pct, sma_7d, sma_30d, sma_90d, vol_ma_7d, vol_ma_30d,
    price_vs_sma_30d, market_cap_usd, full_time_employees, ingested_at"""

CTE["fct_prices"] = f"select {FCT_SELECT} from moving_averages"
CTE["dim_companies"] = "select * from stg_companies"

CTE["job_log"] = """
  select event_id as query_id,
    concat(case when event_id % 3 = 0 then 'MERGE INTO ' else 'SELECT * FROM ' end,
           case when user_id % 2 = 0 then 'fct_stock_prices' else 'other' end) as query_text,
    'ANALYTICS' as database_name, upper(event_type) as schema_name,
    case when event_id % 3 = 0 then 'MERGE' else 'SELECT' end as query_type,
    concat('WH_', cast(user_id % 4 as varchar)) as warehouse_name,
    case when event_type = 'error' then 'FAIL' else 'SUCCESS' end as execution_status,
    ts as start_time,
    ts + to_milliseconds(cast(round(value * 1000) as bigint)) as end_time,
    value * 1000 as total_elapsed_time,
    cast(json_extract_string(props, '$.k') as bigint) * 1048576 as bytes_scanned,
    case when cast(json_extract_string(props, '$.k') as bigint) % 5 = 0
         then cast(json_extract_string(props, '$.k') as bigint) * 65536 else 0 end
      as bytes_spilled_to_local_storage,
    cast(json_extract_string(props, '$.k') as bigint) % 10 as partitions_scanned,
    case when cast(json_extract_string(props, '$.k') as bigint) % 7 = 0 then 0 else 10 end
      as partitions_total,
    value * 0.001 as credits_used_cloud_services
  from events"""

CTE["metering"] = """
  select ts as start_time, cast(cast(value as decimal(18,2)) as decimal(20,4)) as credits_used,
    cast(cast(value as decimal(18,2)) * cast(0.75 as decimal(3,2)) as decimal(20,4))
      as credits_used_compute,
    cast(cast(value as decimal(18,2)) as decimal(20,4))
      - cast(cast(value as decimal(18,2)) * cast(0.75 as decimal(3,2)) as decimal(20,4))
      as credits_used_cloud_services,
    concat('WH_', cast(user_id % 4 as varchar)) as warehouse_name
  from events"""

# Dependencies between CTEs (each CTE lists what it reads).
DEPS = {
    "supplier_bars": [], "raw_prices": ["supplier_bars"], "company_base": [],
    "raw_companies": ["company_base"], "event_raw": [], "event_prices": ["event_raw"],
    "stg_prices": ["raw_prices"], "stg_event_prices": ["event_prices"],
    "company_renamed": ["raw_companies"], "company_dedup": ["company_renamed"],
    "stg_companies": ["company_dedup"], "prices_joined": ["stg_prices", "stg_companies"],
    "daily_returns": ["prices_joined"], "event_returns": ["stg_event_prices"],
    "moving_averages": ["daily_returns"], "event_moving_averages": ["event_returns"],
    "adjusted_prices": ["stg_prices"], "adjusted_returns": ["adjusted_prices"],
    "adjusted_moving_averages": ["adjusted_returns"],
    "fct_prices": ["moving_averages"], "dim_companies": ["stg_companies"],
    "job_log": [], "metering": [],
}


def with_ctes(final: str, *needs: str, extra: dict[str, str] | None = None) -> str:
    """Assemble ``with ... select`` with the CTEs ``needs`` (and their dependencies) in order."""
    ctes = dict(CTE)
    deps = dict(DEPS)
    for name, body in (extra or {}).items():
        ctes[name] = body[0] if isinstance(body, tuple) else body
        deps[name] = list(body[1]) if isinstance(body, tuple) else []
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in deps.get(n, []):
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    body = ",\n".join(f"{n} as ({ctes[n]})" for n in order)
    return f"with {body}\n{final}"
