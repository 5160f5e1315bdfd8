"""Per-ticker time-series windows without one-task-per-ticker.

The reference computes every window ``partition by ticker order by price_date``.  Written that
way in Spark, one task holds a ticker's whole history.  Here the same values are computed with
ONE full-width shuffle, partitioned by (ticker, calendar chunk of ``chunk_days`` days).  Since
(ticker, price_date) is unique, a chunk holds at most ``chunk_days`` rows whatever the skew.

What a chunk cannot see by itself (rows of earlier chunks) comes from a narrow side table with one
row per (ticker, chunk), built in two small steps:

1. ``chunk_stats``: windows over the narrow columns (date, close, volume) per (ticker, chunk),
   then an aggregate of their last rows on the same partitioning, keeps the row count, first and last close, the
   exact sum / count of the returns *inside* the chunk, and the chunk's last ``LOOKBACK`` rows
   (the only collected list, so bounded by ``LOOKBACK``).
2. ``chunk_context``: a window over that small table per ticker, ordered by chunk, gives each
   chunk its start offset (running row count), the running sum / count of returns before it
   (using the previous chunk's last close for the chunk's first return), and the last
   ``LOOKBACK`` rows before it.  The context is gathered with a RANGE frame on the start offset,
   so it reads at most the chunks that start in the last ``LOOKBACK`` rows plus the one
   straddling that boundary (at most 2 x ``LOOKBACK`` entries), never a whole history.

The context rows are exploded and unioned in front of the chunk's own rows (they carry the
chunk's start offset and return prefix too), so ONE exchange on (ticker, chunk) feeds the main
pass and every frame is an ordinary in-partition frame.  Inside each chunk it computes
``trading_day_seq`` = start + own-row count, lag, returns, 7/30/90-row averages and volume
averages as differences of running sums, and the cumulative mean (prefix + running sum).  Sums
are exact integers, so the half-up rounded averages do not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.functions.scalar import exact_ratio, price_avg, price_parts, safe_divide, sma_signal

# Rows of history the widest bounded frame needs before the current row (90-row average).
LOOKBACK = 89
# Calendar days per chunk: at most this many rows per ticker per chunk.
CHUNK_DAYS = 1464
PRICE_WINDOWS = (7, 30, 90)
VOLUME_WINDOWS = (7, 30)

SEQ = "trading_day_seq"
# --------------------------------------------------------------------------------------------
# Published column lists of the two series models
# --------------------------------------------------------------------------------------------
COMPANY_COLUMNS = ["company_id", "company_name", "sector", "industry", "country", "exchange",
                   "currency", "market_cap_usd", "market_cap_category", "full_time_employees"]
AUDIT_COLUMNS = ["ingested_at", "dbt_updated_at"]

RETURNS_COLUMNS = [
    "stock_price_id", "ticker", "price_date", "open_price", "high_price", "low_price",
    "close_price", "prev_close_price", "volume", "price_change", "pct_change_open_to_close",
    "daily_return_pct", "intraday_range", "intraday_range_pct", SEQ,
    *COMPANY_COLUMNS, *AUDIT_COLUMNS,
]
MOVING_AVERAGE_COLUMNS = [
    "stock_price_id", "ticker", "price_date", SEQ, "open_price", "high_price", "low_price",
    "close_price", "prev_close_price", "volume", "price_change", "pct_change_open_to_close",
    "daily_return_pct", "intraday_range", "intraday_range_pct", "cumulative_avg_return_pct",
    "sma_7d", "sma_30d", "sma_90d", "vol_ma_7d", "vol_ma_30d", "price_vs_sma_30d",
    *COMPANY_COLUMNS, *AUDIT_COLUMNS,
]
DERIVED = ["prev_close_price", "daily_return_pct", "intraday_range", "intraday_range_pct", SEQ,
           "cumulative_avg_return_pct", "sma_7d", "sma_30d", "sma_90d", "vol_ma_7d",
           "vol_ma_30d", "price_vs_sma_30d"]



def _ordered(df: DataFrame, order: list[str]) -> DataFrame:
    """Select the published column order; absent columns are skipped, extras kept at the end."""
    present = [c for c in order if c in df.columns]
    extra = [c for c in df.columns if c not in order]
    return df.select(*present, *extra)


def daily_return(close: Column, prev: Column) -> Column:
    """round(safe_divide(close - prev, prev) * 100, 4) - the one definition used everywhere."""
    return F.round(safe_divide(close - prev, prev) * 100, 4)


def chunk_of(order: str, chunk_days: int) -> Column:
    """Number of the calendar chunk that a date lies in."""
    return F.floor(F.datediff(F.col(order), F.lit("1970-01-01")) / F.lit(chunk_days))


# --------------------------------------------------------------------------------------------
# Side table
# --------------------------------------------------------------------------------------------
def chunk_stats(df: DataFrame, key: str, order: str, chunk_days: int, lookback: int,
                with_returns: bool, loaded: str | None = None) -> DataFrame:
    """One row per (key, chunk): row count, first/last close, the chunk's last ``lookback`` rows
    and - for averages - the exact sum / count of the returns between consecutive rows inside it.
    Windows over the narrow columns (they spill like any sort) followed by an aggregate of the tails on
    the same partitioning; the only collected list holds at most ``lookback`` rows.  With ``loaded``, also
    the latest load time of the chunk's rows."""
    narrow = df.select(key, chunk_of(order, chunk_days).alias("_chunk"), order, "close_price",
                       "volume", *([loaded] if loaded else []))
    whole = Window.partitionBy(key, "_chunk")
    w = whole.orderBy(order, "close_price", "volume")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = narrow.withColumns({
        "_pos": F.row_number().over(w),
        "_lagc": F.lag("close_price").over(w),
        "_first_c": F.first("close_price").over(run),
        "_n": F.count(F.lit(1)).over(whole),
        **({"_hwm": F.max(loaded).over(whole)} if loaded else {}),
    })
    if with_returns:
        ret = _units(daily_return(F.col("close_price"), F.col("_lagc")), 4)
        x = x.withColumns({"_in_rs": F.sum(F.coalesce(ret, F.lit(0))).over(run), "_in_rn": F.count(ret).over(run)})
    # The last row of a chunk knows its figures, so only the rows of the tails are aggregated: the aggregate
    # of a list sorts its input once more, and would hold (or spill) every row.
    at_end = lambda c, name: F.max(F.when(F.col("_pos") == F.col("_n"), F.col(c))).alias(name)
    tail = F.struct(F.col(order).alias("d"), F.col("close_price").alias("c"), F.col("volume").alias("v"))
    more = [c for c in ("_in_rs", "_in_rn", "_hwm") if c in x.columns]
    return x.filter(F.col("_pos") > F.col("_n") - lookback).groupBy(key, "_chunk").agg(
        F.max("_n").alias("_n"), at_end("_first_c", "_first_c"), at_end("close_price", "_last_c"),
        F.array_sort(F.collect_list(tail)).alias("_tail"), *[at_end(c, c) for c in more])


def chunk_context(stats: DataFrame, key: str, lookback: int, with_returns: bool) -> DataFrame:
    """Per chunk: start offset, the last ``lookback`` rows before the chunk and, for averages,
    the return prefix (sum in 1e-4 units and count of the returns before the chunk)."""
    by_chunk = Window.partitionBy(key).orderBy("_chunk")
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    s = stats.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long"))
    by_start = Window.partitionBy(key).orderBy("_start")
    near = F.flatten(F.collect_list("_tail").over(by_start.rangeBetween(-lookback, -1)))
    straddle = F.last("_tail").over(
        by_start.rangeBetween(Window.unboundedPreceding, -(lookback + 1)))
    s = s.withColumns({"_near": near, "_straddle": straddle})
    none = F.filter("_near", lambda r: F.lit(False))   # empty array of the element type
    s = s.withColumn("_all", F.concat(F.coalesce("_straddle", none), "_near"))
    cols = [key, "_chunk", "_start",
            F.slice("_all", F.greatest(F.size("_all") - lookback + 1, F.lit(1)),
                    lookback).alias("_ctx")]
    if with_returns:
        first_r = _units(daily_return(F.col("_first_c"), F.lag("_last_c").over(by_chunk)), 4)
        s = s.withColumns({
            "_cs": (F.col("_in_rs") + F.coalesce(first_r, F.lit(0))).cast("decimal(38,0)"),
            "_cn": F.col("_in_rn") + F.when(first_r.isNotNull(), 1).otherwise(0),
        })
        cols += [F.coalesce(F.sum("_cs").over(before), F.lit(0).cast("decimal(38,0)")).alias("_ps"),
                 F.coalesce(F.sum("_cn").over(before), F.lit(0)).alias("_pn")]
    return s.select(*cols)


# --------------------------------------------------------------------------------------------
# State of published series: what an increment needs of the history, one row per key and chunk
# --------------------------------------------------------------------------------------------
def series_state(df: DataFrame, key: str = "ticker", order: str = "price_date",
                 state: DataFrame | None = None, chunk_days: int = CHUNK_DAYS,
                 loaded: str = "ingested_at") -> DataFrame:
    """One row per (key, chunk): number of rows, first, last close and last date, exact sum and count of
    the returns inside, latest load time (the greatest is the watermark), and the last ``LOOKBACK``
    rows.  With ``state``, ``df`` holds only rows after those that it covers; they may go on in a chunk
    that it has, and chunks without new rows stay as they are."""
    out = chunk_stats(df, key, order, chunk_days, LOOKBACK, True, loaded)
    if state is not None:
        names = out.columns
        both = (state.select(*names).withColumn("_new", F.lit(0))
                .unionByName(out.withColumn("_new", F.lit(1))))
        link = _units(daily_return(F.col("_b"), F.col("_a")), 4)       # the return from the old to the new rows
        tails = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_new", "_tail"))), lambda x: x["_tail"]))
        out = both.groupBy(key, "_chunk").agg(                         # two rows at most
            F.sum("_n").alias("_n"), F.min_by("_first_c", "_new").alias("_first_c"),
            F.max_by("_last_c", "_new").alias("_last_c"), F.sum("_in_rs").alias("_rs"), F.sum("_in_rn").alias("_rn"),
            F.max(F.when(F.col("_new") == 0, F.col("_last_c"))).alias("_a"),
            F.max(F.when(F.col("_new") == 1, F.col("_first_c"))).alias("_b"),
            F.max("_hwm").alias("_hwm"), tails.alias("_all"))
        out = out.withColumns({
            "_in_rs": F.col("_rs") + F.coalesce(link, F.lit(0)),
            "_in_rn": F.col("_rn") + F.when(link.isNotNull(), 1).otherwise(0),
            "_tail": F.slice("_all", F.greatest(F.size("_all") - LOOKBACK + 1, F.lit(1)), LOOKBACK)}).select(*names)
    return out.withColumn("_last_d", F.element_at("_tail", -1)["d"])


def chunk_start(chunk: Column, chunk_days: int) -> Column:
    """First day of a chunk."""
    return F.date_add(F.lit("1970-01-01").cast("date"), (chunk * chunk_days).cast("int"))


def _after_state(stats: DataFrame, state: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Chunk rows of the new rows and of the state of their keys, numbered so that a chunk of the state
    (2k) comes before the new rows of the same chunk (2k + 1)."""
    old = state.join(keys, key, "left_semi").withColumn("_chunk", F.col("_chunk") * 2)
    return stats.withColumn("_chunk", F.col("_chunk") * 2 + 1).unionByName(old.select(*stats.columns))


# --------------------------------------------------------------------------------------------
# Main pass
# --------------------------------------------------------------------------------------------
def _units(x: Column, scale: int) -> Column:
    """Exact integer units of a value carrying at most ``scale`` decimals (cents for 2)."""
    return F.round(x * (10 ** scale)).cast("long")


def context_rows(ctx: DataFrame, key: str, order: str, side: list[str]) -> DataFrame:
    """The look-back rows of every chunk as narrow rows of that chunk (``_own`` = false); they
    also carry the chunk's side values (start offset, return prefix)."""
    x = ctx.select(key, "_chunk", *side, F.explode("_ctx").alias("_x"))
    return x.select(key, "_chunk", *side, F.col("_x.d").alias(order),
                    F.col("_x.c").alias("close_price"), F.col("_x.v").alias("volume"),
                    F.lit(False).alias("_own"))


def series_metrics(df: DataFrame, key: str = "ticker", order: str = "price_date",
                   averages: bool = True, chunk_days: int = CHUNK_DAYS,
                   state: DataFrame | None = None, stats: DataFrame | None = None,
                   attach: DataFrame | None = None, derived: dict[str, Column] | None = None) -> DataFrame:
    """Add the per-ticker series columns: sequence, previous close, returns, intraday range and,
    with ``averages``, the moving averages, volume averages, cumulative mean return and signal.

    Each chunk gets its look-back rows (the previous row, or the previous ``LOOKBACK`` rows for
    averages) from the side table, unioned in front of its own rows; so every frame is an
    ordinary in-partition frame, and ONE exchange on (key, chunk) feeds the whole pass.  The
    context rows also carry the chunk's start offset and return prefix (a chunk without context
    rows is the first of its key, where both are zero).  Moving sums are differences of running
    sums (``R(p) - R(p - n)``, one ``lag`` each), so the cost per row does not grow with the frame
    width.  Sums are exact integers: prices are summed as wholes and as fractions at 1e-10, so
    adjusted prices keep all their digits and an average rounds half up like ``round(avg(..), 4)``
    of the true sum.

    ``state`` (:func:`series_state`) stands for the history before the rows of ``df``, which must
    be later than it covers: only the new rows are computed.

    ``stats`` may be the stored state of exactly the rows of ``df``, so that the side table is not
    computed again.  ``attach`` holds columns per key that every row of the key gets (a left join): its rows
    are dealt to the key's chunks and joined on (key, chunk), by which the pass is partitioned and
    sorted already, so the wide rows do not move for it whatever the size of ``attach``.  ``derived`` are
    columns of ``df`` that follow from its others: they are not shuffled but computed after the pass."""
    more = derived or {}
    base = df.drop(*[c for c in DERIVED if c in df.columns], *more)
    lookback = LOOKBACK if averages else 1
    side = ["_start", "_ps", "_pn"] if averages else ["_start"]
    if attach is not None:
        chunks = base.select(key, chunk_of(order, chunk_days).alias("_chunk")) if stats is None else stats.select(key, "_chunk")
        attach = chunks.distinct().join(attach, key)
    if stats is None:
        stats = chunk_stats(base, key, order, chunk_days, lookback, averages)
    if state is not None:
        stats = _after_state(stats, state, base.select(key).distinct(), key)
    ctx = chunk_context(stats, key, lookback, averages)
    if state is not None:
        ctx = (ctx.filter(F.col("_chunk").bitwiseAND(F.lit(1)) == 1)
               .withColumn("_chunk", F.shiftright("_chunk", 1)))
    data = base.withColumns({"_chunk": chunk_of(order, chunk_days), "_own": F.lit(True)})
    d = data.unionByName(context_rows(ctx, key, order, side), allowMissingColumns=True)
    w = Window.partitionBy(key, "_chunk").orderBy(order, "close_price", "volume")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.col("_own")

    def one_if(c: Column) -> Column:
        return F.when(c, 1).otherwise(0)

    # Window operator 1 (no dependency on other window results).  Context rows sort first
    # (earlier chunks hold earlier dates), so their side values are the first non-null values
    # of the running frame; the sequence counts own rows only.
    first = {
        "_start": F.coalesce(F.first("_start", ignorenulls=True).over(run), F.lit(0)),
        "_pos": F.sum(one_if(own)).over(run),
        "prev_close_price": F.lag("close_price").over(w),
    }
    if averages:
        first.update({
            "_ps": F.coalesce(F.first("_ps", ignorenulls=True).over(run),
                              F.lit(0).cast("decimal(38,0)")),
            "_pn": F.coalesce(F.first("_pn", ignorenulls=True).over(run), F.lit(0)),
            "_Rc": F.sum(F.coalesce(price_parts("close_price")[0], F.lit(0))).over(run),
            "_Rf": F.sum(F.coalesce(price_parts("close_price")[1], F.lit(0))).over(run),
            "_Rcn": F.sum(one_if(F.col("close_price").isNotNull())).over(run),
        })
    d = d.withColumns(first)
    d = d.withColumns({
        SEQ: (F.col("_start") + F.col("_pos")).cast("int"),
        "daily_return_pct": daily_return(F.col("close_price"), F.col("prev_close_price")),
        "intraday_range": F.round(F.col("high_price") - F.col("low_price"), 4),
        "intraday_range_pct": F.round(
            safe_divide(F.col("high_price") - F.col("low_price"), F.col("close_price")) * 100, 4),
    })
    def attached(x: DataFrame) -> DataFrame:
        return x if attach is None else x.join(attach, [key, "_chunk"], "left")

    helpers = ["_chunk", "_own", "_start", "_pos"]
    if not averages:
        return _ordered(attached(d.filter(own)).drop(*helpers).withColumns(more), RETURNS_COLUMNS)

    # Window operators 2 and 3: moving sums as R(p) - R(p - n), and the running return sum.  Volumes and the
    # wider price averages are a step behind, because all quotients in one projection become a generated
    # method of more than 8,000 bytes, which the JVM never compiles.
    def moving(r: str, n: int) -> Column:
        return F.col(r) - F.coalesce(F.lag(r, n).over(w), F.lit(0))

    ret_units = _units(F.col("daily_return_pct"), 4)
    cols = {
        "_Rv": F.sum(F.coalesce(F.col("volume"), F.lit(0))).over(run),
        "_Rvn": F.sum(one_if(F.col("volume").isNotNull())).over(run),
        "_rs": F.sum(F.when(own, F.coalesce(ret_units, F.lit(0))).otherwise(0)).over(run),
        "_rn": F.sum(one_if(own & ret_units.isNotNull())).over(run),
    }
    narrowest, *wider = PRICE_WINDOWS
    parts = ("_Rc", "_Rf", "_Rcn")
    cols[f"sma_{narrowest}d"] = price_avg(*[moving(r, narrowest) for r in parts])
    sums = {f"{r}_{n}": moving(r, n) for n in wider for r in parts}
    d = d.withColumns({**cols, **sums})
    cols = {**{f"sma_{n}d": price_avg(*[f"{r}_{n}" for r in parts]) for n in wider},
            "cumulative_avg_return_pct": exact_ratio(F.col("_ps") + F.col("_rs"), F.col("_pn") + F.col("_rn"), 4, 4)}
    for n in VOLUME_WINDOWS:
        # avg(bigint) is a DOUBLE division of an exact integer sum by the count.
        cols[f"vol_ma_{n}d"] = F.round(moving("_Rv", n).cast("double")
                                       / F.nullif(moving("_Rvn", n), F.lit(0)).cast("double"),
                                       0).cast("bigint")
    d = attached(d.withColumns(cols).filter(own))
    d = d.withColumns({"price_vs_sma_30d": sma_signal("close_price", "sma_30d"), **more})
    return _ordered(d.drop(*helpers, "_ps", "_pn", "_Rc", "_Rf", "_Rcn", "_Rv", "_Rvn", "_rs", "_rn", *sums),
                    MOVING_AVERAGE_COLUMNS)


# --------------------------------------------------------------------------------------------
# Public jobs (the reference's intermediate models)
# --------------------------------------------------------------------------------------------
def daily_returns(df: DataFrame, key: str = "ticker", order: str = "price_date",
                  chunk_days: int = CHUNK_DAYS, attach: DataFrame | None = None,
                  derived: dict[str, Column] | None = None) -> DataFrame:
    """Previous close, day-over-day return %, intraday range and %, trading-day sequence."""
    return series_metrics(df, key, order, averages=False, chunk_days=chunk_days, attach=attach, derived=derived)


def moving_averages(df: DataFrame, key: str = "ticker", order: str = "price_date",
                    chunk_days: int = CHUNK_DAYS, attach: DataFrame | None = None,
                    derived: dict[str, Column] | None = None) -> DataFrame:
    """7/30/90-row price averages, 7/30-row volume averages, cumulative mean return and the
    close-vs-30-row-average signal, on top of :func:`daily_returns` output (whose columns are
    recomputed in the same pass, with identical values)."""
    return series_metrics(df, key, order, averages=True, chunk_days=chunk_days, attach=attach, derived=derived)
