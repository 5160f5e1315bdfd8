"""Incremental publication: high-watermark filter, key upsert, changed-ticker pruning.

Semantics kept from the reference's incremental marts:

* watermark: only rows with ``ingested_at > max(target.ingested_at)`` are processed (strict, so
  a row equal to the max or older is never loaded); an absent target loads everything, an empty
  one every row that has a load time;
* merge on a unique key: a batch row replaces the target row with the same key, new keys are
  inserted, target rows absent from the batch are kept; nothing is deleted.  A key that a batch
  holds several times is reduced to its latest load first (``latest_per_key``).

The watermark is a scalar subquery (``DataFrame.scalar()``), evaluated by the engine: nothing is
collected to the driver.  New rows are computed from the stored state of their ticker's series, and
where they fall inside it, from their chunk of the history on; either gives the rows of a full
recomputation.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.operators.intermediate import company_columns
from pricelake.operators.marts import FCT_KEY, FCT_PARTS, fct_prices
from pricelake.operators.series import CHUNK_DAYS, chunk_of, chunk_start, series_state
from pricelake.operators.staging import price_derived

WATERMARK = "ingested_at"


def watermark(target: DataFrame, col: str = WATERMARK) -> Column:
    """``(select max(col) from target)`` as a Column; for an empty target a time before all
    others, so that every row that has a load time is newer."""
    first = F.lit("0001-01-01 00:00:00").cast(target.schema[col].dataType)
    return target.agg(F.coalesce(F.max(col), first)).scalar()


def newer_than(col: str, hwm: Column) -> Column:
    """Row predicate of the incremental filter: a plain ``col > hwm``, which Spark pushes into the
    scan once the subquery's value is known."""
    return F.col(col) > hwm


def new_rows(source: DataFrame, target: DataFrame | None, col: str = WATERMARK) -> DataFrame:
    if target is None:
        return source
    return source.filter(newer_than(col, watermark(target, col)))


def matched(rows: DataFrame, others: DataFrame, key: str | list[str], parts: list[str] | None, how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join on the key.  ``parts`` are the columns that the key is the digest of, and
    never null (a staged bar has both): they tell the same rows apart, but come in order and compress."""
    on = parts or ([key] if isinstance(key, str) else list(key))
    return rows.join(others.select(*on), on, how).select(*rows.columns)


def upsert(target: DataFrame | None, batch: DataFrame, key: str | list[str],
           batch_keys: DataFrame | None = None, follows: str | None = None,
           parts: list[str] | None = None, derived: dict[str, Column] | None = None) -> DataFrame:
    """Merge ``batch`` into ``target`` on ``key``: replace matches, insert new, keep the rest.

    The anti-join reads only the batch keys; AQE broadcasts them when the batch is small (the
    usual daily increment) and shuffles otherwise.  When the batch is an expensive plan, pass
    ``batch_keys``: a cheap DataFrame holding exactly the batch's keys, so the batch plan is not
    run a second time just to produce its keys.

    ``follows`` is a column that the key determines, such as the date of a bar (``batch_keys`` must hold
    it): target rows outside the batch's range of it cannot match, and are kept without a join.

    ``parts`` are columns that the key is the digest of (``batch_keys`` holds them instead of it), and
    ``derived`` columns of the target that follow from its others, the key if there are ``parts``: the target
    rows are joined without them, and they are computed after that."""
    if target is None:
        return batch
    given, more = batch if batch_keys is None else batch_keys, derived or {}

    def not_in_batch(rows):
        return matched(rows.drop(*more), given, key, parts, "left_anti").withColumns(more).select(*batch.columns)

    if follows is None:
        return batch.unionByName(not_in_batch(target))
    lo, hi = given.agg(F.min(follows)).scalar(), given.agg(F.max(follows)).scalar()
    inside = F.coalesce(F.col(follows).between(lo, hi), F.lit(True))      # also a null, and all for an empty batch
    return batch.unionByName(target.filter(~inside).select(*batch.columns)).unionByName(not_in_batch(target.filter(inside)))


def latest_per_key(batch: DataFrame, key: str | list[str], newest: list[str], parts: list[str] | None = None,
                   derived: dict[str, Column] | None = None) -> DataFrame:
    """One row per key: that with the greatest ``newest`` columns (nulls last); of rows that agree
    in those, the greatest by all other columns, so a re-run keeps the same one.  A limit before
    the shuffle keeps a key that was delivered very often from travelling whole.

    ``parts`` are columns that the key is the digest of: rows are grouped by them.  ``derived`` are columns,
    the key among them, that follow from ``parts`` or from columns before them in that order, so they decide
    nothing: they are not shuffled but computed after it."""
    keys, more = [key] if isinstance(key, str) else list(key), derived or {}
    rest = sorted(c for c in batch.columns if c not in keys and c not in newest and c not in more and c not in (parts or []))
    w = Window.partitionBy(*(parts or keys)).orderBy(*[F.col(c).desc_nulls_last() for c in [*newest, *rest]])
    return (batch.drop(*more).withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1)
            .withColumns(more).select(*batch.columns))


def latest_bars(staged_rows: DataFrame, newest: list[str]) -> DataFrame:
    """``latest_per_key`` of staged bars.  What follows from their other columns is not shuffled."""
    return latest_per_key(staged_rows, FCT_KEY, newest, FCT_PARTS, price_derived())


#: Date (or none) -> staged rows from then on.
History = Callable[[datetime.date | None], DataFrame]


def staged(stg_p: DataFrame) -> History:
    """The history as the staged rows hold it."""
    return lambda since: stg_p if since is None else stg_p.filter(F.col("price_date") >= F.lit(since))


def fct_increment(stg_p: DataFrame, stg_c: DataFrame, target: DataFrame | None,
                  state: DataFrame | None = None, backfill: bool = False,
                  newest: list[str] | None = None, keep: Callable[[DataFrame], DataFrame] = lambda df: df,
                  history: History | None = None, keep_state: Callable[[DataFrame], DataFrame] = lambda df: df,
                  **series_opts) -> tuple[DataFrame, DataFrame]:
    """The batch of an incremental fact run, fact rows newer than the target's watermark, and the
    state of the series after it.

    New rows that come after everything published of their ticker are computed from ``state``, so
    the history is not read.  A ticker with a new row on or before its last published date (a late
    back-fill, a corrected or re-delivered bar) is computed anew from the chunk of that row on, and
    what lies before it comes from the state; of each (ticker, date) the latest load counts.  Without a
    state every changed ticker is computed from its whole history.

    ``history(since)`` gives the staged rows from a date on (all, if none), and may leave out new rows;
    by default they are read from ``stg_p``.

    ``backfill=True`` goes beyond the reference: for those tickers the batch also carries every
    recomputed row on or after the earliest new date, exactly the rows whose windows changed.

    The watermark is the state's where there is one (a few rows per ticker instead of the target).
    ``keep`` may store the new rows, which are used several times.  ``keep_state`` may store the state of a
    first build, from which its rows are then computed."""
    newest = newest or [WATERMARK]
    if target is None:
        after = keep_state(series_state(stg_p, **series_opts))
        return fct_prices(stg_p, stg_c, stats=after, **series_opts), after
    hwm = watermark(target) if state is None else watermark(state, "_hwm")
    new = keep(latest_bars(stg_p.filter(newer_than(WATERMARK, hwm)), newest))
    return increment_of(new, history or staged(stg_p), stg_c, state, backfill, newest, **series_opts)


def increment_of(new: DataFrame, history: History, stg_c: DataFrame, state: DataFrame | None,
                 backfill: bool, newest: list[str], chunk_days: int = CHUNK_DAYS,
                 keep_part: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> tuple[DataFrame, DataFrame]:
    """``fct_increment`` for given new rows, unique by key.  ``keep_part`` may store, under a name, what is
    used several times: the late tickers, and the rows and chunk rows that they are computed from."""
    def published(rows, before=None, stats=None):
        return fct_prices(rows, stg_c, state=before, stats=stats, chunk_days=chunk_days)

    def after(rows, before=None):
        return series_state(rows, state=before, chunk_days=chunk_days)

    def again(late, before):
        """Rows of the late tickers that are published again, and all that they were computed from."""
        since = None if before is None else late.agg(F.min("_since")).collect()[0][0]
        old = history(since).join(late, "ticker")
        if before is not None:
            old = old.filter(F.col("price_date") >= F.col("_since"))
        old = latest_bars(matched(old.select(*new.columns), new, FCT_KEY, FCT_PARTS, "left_anti"), newest)
        scope = keep_part("scope", old.unionByName(new.join(late.select("ticker"), "ticker", "left_semi").select(*new.columns)))
        chunks = None if before is None else keep_part("chunks", after(scope))
        rows = published(scope, before, chunks)
        if backfill:
            kept = rows.join(late, "ticker").filter(F.col("price_date") >= F.col("_from"))
        else:
            kept = matched(rows, new, FCT_KEY, FCT_PARTS, "left_semi")
        return kept.select(*rows.columns), chunks

    first = new.groupBy("ticker").agg(F.min("price_date").alias("_from"))
    if state is None:
        batch, _ = again(first, None)
        whole = matched(history(None).select(*new.columns), new, FCT_KEY, FCT_PARTS, "left_anti")
        return batch, after(latest_bars(whole, newest).unionByName(new))
    last = state.groupBy("ticker").agg(F.max("_last_d").alias("_last"))
    late = first.join(last, "ticker").filter(F.col("_from") <= F.col("_last")).drop("_last")
    if late.isEmpty():
        return published(new, state), after(new, state)
    at = chunk_of("_from", chunk_days)
    late = keep_part("late", late.withColumns({"_at": at, "_since": chunk_start(at, chunk_days)}))
    before = (state.join(late.select("ticker", "_at"), "ticker").filter(F.col("_chunk") < F.col("_at"))
              .select(*state.columns))
    batch, chunks = again(late, before)
    on_time, rest = (x.join(late.select("ticker"), "ticker", "left_anti").select(*x.columns) for x in (new, state))
    return (published(on_time, rest).unionByName(batch),
            after(on_time, rest).unionByName(before).unionByName(chunks))


def fct_incremental(stg_p: DataFrame, stg_c: DataFrame, target: DataFrame | None,
                    state: DataFrame | None = None, backfill: bool = False,
                    **series_opts) -> DataFrame:
    """Target after an incremental run, as one plan: ``upsert(target, batch)``.  (``plans.warehouse``
    writes the batch as a layer instead and touches only its months.)"""
    batch, _ = fct_increment(stg_p, stg_c, target, state, backfill, **series_opts)
    return batch if target is None else upsert(target, batch, FCT_KEY)


def dim_incremental(stg_c: DataFrame, target: DataFrame | None) -> DataFrame:
    from pricelake.operators.marts import DIM_KEY, dim_companies
    return upsert(target, new_rows(dim_companies(stg_c), target), DIM_KEY)
