"""The build as the reference runs it: load RAW, build the marts, test them.

* ``land_raw``   RAW layer: tables derived from the driver's tables, written as parquet (the
                 loaders' full refresh, as a new version of the table).  Price extracts go through a
                 text stage into typed tables, with non-casting rows kept in ``<name>_rejects``.
* ``load_csv`` / ``load_company_json``  the same RAW tables from landed files.
* ``build``      staging views -> marts.  A full refresh writes the fact table by month and the
                 state of its series; an increment computes the rows after the watermark from
                 that state and writes a layer of the months they fall into
                 (a layer being read is never overwritten).
* ``run_tests``  the quality summary over the published marts.

``Warehouse`` keeps one such layout per (Spark application, input folder) under the shared
checkpoint folder, so queries in one session read RAW and published marts like the reference's
models and dashboard read warehouse tables, instead of re-deriving them per query.
"""

from __future__ import annotations

import datetime
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators import incremental, intermediate, marts, quality, staging
from pricelake.session import scratch_path
from pricelake.sources import driver_tables as D
from pricelake.sources import files, manifest
from pricelake.plans import layers, monthly
from pricelake.streaming.folders import fingerprint

RAW_TABLES = {
    "raw_stock_prices": D.raw_prices,
    "raw_company_metadata": D.raw_companies,
    "raw_event_prices": D.event_bars,
    "query_history": D.job_log,
    "warehouse_metering_history": D.metering,
}
# Price extracts arrive as text (like a CSV stage) and are loaded into typed RAW tables; rows
# whose text does not cast are kept aside in ``<name>_rejects`` (continue-on-error load).
TYPED_LOADS = {"raw_stock_prices": files.RAW_PRICE_TYPES,
               "raw_event_prices": files.RAW_PRICE_TYPES}
RAW, MARTS, STAGE = "RAW", "MARTS", "STAGE"


def land_raw(spark: SparkSession, sf_dir: str, root: str,
             names: list[str] | None = None) -> dict[str, str]:
    """Full-refresh load of the RAW tables; returns their paths.

    Text extracts are first written to ``STAGE/<name>``; the typed RAW table and its rejects are
    then loaded from that stage (a cheap re-read), so the extract is derived only once."""
    out = {}
    for name in names or list(RAW_TABLES):
        path = files.layer_path(root, RAW, name)
        if name in TYPED_LOADS:
            stage = files.layer_path(root, STAGE, name)
            extract = files.stored(RAW_TABLES[name](spark, sf_dir), stage)
            good, rejects = files.split_rejects(extract, TYPED_LOADS[name])
            out.update(load(good, rejects, root, name))
            out[f"stage:{name}"] = stage
        else:
            out[name] = files.full_refresh(RAW_TABLES[name](spark, sf_dir), path)
    return out


def load(good: DataFrame, rejects: DataFrame, root: str, name: str) -> dict[str, str]:
    """Replace a RAW table and its rejects; both are written before either is committed.  Returns the
    folders of their rows."""
    both = {name: good, f"{name}_rejects": rejects}
    written = {t: manifest.write_version(df, files.layer_path(root, RAW, t)) for t, df in both.items()}
    return {t: manifest.commit_version(df, files.layer_path(root, RAW, t), written[t]).folders()[0] for t, df in both.items()}


def load_csv(spark: SparkSession, path: str, root: str, name: str = "raw_stock_prices",
             types: dict[str, str] | None = None) -> dict[str, str]:
    """The loaders' file path: a folder (or glob) of CSV extracts, each read by its own header ->
    typed RAW table (full refresh).  Like a continue-on-error copy, records of the wrong width, rows
    that do not cast and files that lack a column go to ``<name>_rejects``.  If no row can be
    loaded the load fails and RAW keeps what it has."""
    types = types or files.RAW_PRICE_TYPES
    good, rejects = files.split_rejects(files.read_raw_csv(spark, path, list(types)), types)
    return load(staging.arrived(good), rejects, root, name)


def load_company_csv(spark: SparkSession, path: str, root: str,
                     name: str = "raw_company_metadata") -> dict[str, str]:
    """Company records from a named CSV file -> RAW table and rejects, like ``load_csv``."""
    return load_csv(spark, path, root, name, files.RAW_COMPANY_TYPES)


def load_company_json(spark: SparkSession, path: str, root: str,
                      name: str = "raw_company_metadata") -> str:
    """Company records (JSON lines) -> RAW table (full refresh)."""
    return files.full_refresh(files.read_company_records(spark, path), files.layer_path(root, RAW, name))


FCT, DIM = "fct_stock_prices", "dim_companies"
STATE = "STATE"


def current_path(spark: SparkSession, root: str, name: str) -> str | None:
    """Folder that the last run wrote of a mart (the newest layer of the fact table)."""
    home = files.layer_path(root, MARTS, name)
    found = manifest.current(spark, home)
    return f"{home}/{found.info['layer']}" if found else None


def current(spark: SparkSession, root: str, name: str, months: list[str] | None = None) -> DataFrame | None:
    """A mart, or some months of the fact table."""
    found = manifest.current(spark, files.layer_path(root, MARTS, name))
    return None if found is None else manifest.read(spark, found, months)


def state_path(root: str, version: int) -> str:
    """Folder of the series state that belongs to a version of the fact table."""
    return f"{files.layer_path(root, STATE, FCT)}/v={version}"


def inventory(spark: SparkSession, root: str) -> list[tuple[str, str, list[str] | None]]:
    """(layer, table, folders) of every RAW table and current mart; views have no folders."""
    out = []
    for name in [n for t in RAW_TABLES for n in (t, f"{t}_rejects")]:
        if found := manifest.current(spark, files.layer_path(root, RAW, name)):
            out.append((RAW, name, found.folders()))
    out += [("STAGING", n, None) for n in ("stg_stock_prices", "stg_company_metadata")]
    out += [("INTERMEDIATE", n, None) for n in quality.SERIES_MODELS]
    for name in (FCT, DIM):
        if found := manifest.current(spark, files.layer_path(root, MARTS, name)):
            out.append((MARTS, name, found.folders()))
    return out


def staged_history(spark: SparkSession, table: manifest.Manifest, as_of=None):
    """The published bars from a date on (all, if none) as staged rows: reads the months from there."""
    def history(since):
        months = None if since is None else [m for m in table.parts if m >= str(since)[:7]]
        rows = manifest.read(spark, table, months)
        if since is not None:
            rows = rows.filter(F.col("price_date") >= F.lit(since))
        return rows.select(*staging.STG_PRICE_COLUMNS[:-1], staging.updated_at(as_of).alias("dbt_updated_at"))
    return history


def part_derived(name: str):
    """Columns that a stored part of an increment (``keep_part``) need not hold."""
    return staging.price_derived() if name == "scope" else None


def publish_fact(spark: SparkSession, root: str, stg_p: DataFrame, stg_c: DataFrame,
                 full_refresh: bool, backfill: bool = False, as_of=None, **series_opts) -> str:
    """Commit the next version of the fact table, and the series state with it."""
    home = files.layer_path(root, MARTS, FCT)
    found = None if full_refresh else manifest.current(spark, home)
    n = (found.version if found else manifest.last(spark, home)) + 1
    if found:
        batch, after = incremental.fct_increment(
            stg_p, stg_c, manifest.read(spark, found), spark.read.parquet(state_path(root, found.info["state"])), backfill,
            keep=lambda df: files.stored(df, files.layer_path(root, STAGE, f"{FCT}_new_{n}"), staging.price_derived()),
            history=staged_history(spark, found, as_of),
            keep_part=lambda name, df: files.stored(df, files.layer_path(root, STAGE, f"{FCT}_{name}_{n}"), part_derived(name)), **series_opts)
        # stored once: its months are listed, then it is merged
        batch = files.stored(batch, files.layer_path(root, STAGE, f"{FCT}_batch_{n}"), marts.fct_derived())
        files.stored(after, state_path(root, n))
        layers.merge(spark, found, batch, marts.FCT_KEY, marts.FCT_CLUSTER, derived=marts.fct_derived(),
                     parts=marts.FCT_PARTS, state=n)
    else:
        batch, _ = incremental.fct_increment(
            stg_p, stg_c, None, keep_state=lambda df: files.stored(df, state_path(root, n)), **series_opts)
        layers.publish(batch, home, marts.FCT_CLUSTER, derived=marts.fct_derived(), state=n)
    return current_path(spark, root, FCT)


def build(spark: SparkSession, root: str, full_refresh: bool = True, as_of=None,
          **series_opts) -> dict[str, str]:
    """Build both marts from RAW.  Returns the folders written: a full refresh writes whole tables,
    an increment a layer of the fact table."""
    raw_p, raw_c = (files.table(spark, files.layer_path(root, RAW, t)) for t in ("raw_stock_prices", "raw_company_metadata"))
    stg_p, stg_c = staging.stg_prices(raw_p, as_of), staging.stg_companies(raw_c, as_of)
    out = {FCT: publish_fact(spark, root, stg_p, stg_c, full_refresh, as_of=as_of, **series_opts)}
    follow_fact(spark, root)
    home = files.layer_path(root, MARTS, DIM)
    target = None if full_refresh else current(spark, root, DIM)
    dim = (marts.dim_companies(stg_c) if target is None
           else incremental.dim_incremental(stg_c, target))
    n = manifest.write_version(dim, home, lambda df, path: files.write_clustered(df, path, marts.DIM_CLUSTER))
    out[DIM] = manifest.commit_version(dim, home, n).folders()[0]
    return out


#: Tables that follow the fact table month by month.
FOLLOWING = {"fct_figures": monthly.figures, "fct_violations": monthly.violations}


def follow_fact(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables that follow the fact table, brought up to it: reads the months that have changed."""
    fact = manifest.current(spark, files.layer_path(root, MARTS, FCT))
    return {name: manifest.read(spark, monthly.follow(spark, fact, files.layer_path(root, MARTS, name), compute))
            for name, compute in FOLLOWING.items()}


def fact_tests(spark: SparkSession, root: str, as_of=None, expected=None) -> DataFrame:
    """The fact table's tests from the counts that follow it; of its rows only the months from ``as_of``
    (today) on are read."""
    own = follow_fact(spark, root)
    fact = manifest.current(spark, files.layer_path(root, MARTS, FCT))
    day = str(as_of or datetime.date.today())[:7]
    later = manifest.read(spark, fact, [m for m in fact.parts if m >= day])
    return monthly.summary(own["fct_violations"], own["fct_figures"], current(spark, root, DIM), later, as_of, expected)


def models(spark: SparkSession, root: str, as_of=None) -> dict[str, DataFrame]:
    """Every tested table and view by name: RAW and the current marts as written, staging and
    intermediate views as plans over RAW."""
    raw_p, raw_c = (files.table(spark, files.layer_path(root, RAW, t)) for t in ("raw_stock_prices", "raw_company_metadata"))
    stg_p, stg_c = staging.stg_prices(raw_p, as_of), staging.stg_companies(raw_c, as_of)
    averages = intermediate.moving_averages(stg_p, stg_c)
    return {"raw_stock_prices": raw_p, "raw_company_metadata": raw_c,
            "stg_stock_prices": stg_p, "stg_company_metadata": stg_c,
            "int_stock_prices_joined": intermediate.prices_joined(stg_p, stg_c),
            "int_stock_daily_returns": averages, "int_stock_moving_averages": averages,
            "fct_stock_prices": current(spark, root, "fct_stock_prices"),
            "dim_companies": current(spark, root, "dim_companies")}


def run_tests(spark: SparkSession, root: str, as_of=None, expected=None) -> DataFrame:
    """The summary of all declared tests over all layers."""
    return quality.run_all(spark, models(spark, root, as_of), as_of, expected)


class Warehouse:
    """RAW tables and published marts of one input folder, laid out once per session."""

    _registry: dict[tuple[str, str], Warehouse] = {}
    _lock = threading.RLock()     # queries may be run from several threads on one session

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = scratch_path(spark, "warehouse")
        self._raw: dict[str, str] = {}
        self._published = False

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Warehouse:
        # other files in the folder are another warehouse
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), fingerprint(spark, sf_dir))
        with cls._lock:
            if key not in cls._registry:
                cls._registry[key] = cls(spark, sf_dir)
            return cls._registry[key]

    def raw(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._raw:
                self._raw.update(land_raw(self.spark, self.sf_dir, self.root, [name]))
            return self.spark.read.parquet(self._raw[name])

    def stage(self, name: str) -> DataFrame:
        """The text extract a typed RAW table was loaded from (as files would arrive)."""
        self.raw(name)
        return self.spark.read.parquet(self._raw[f"stage:{name}"])

    def once(self, name: str, write) -> str:
        """The path of something that ``write(path)`` writes once per session."""
        path = files.layer_path(self.root, "DERIVED", name)
        with self._lock:
            if name not in self._raw:
                write(path)
                self._raw[name] = path
        return path

    def derived(self, name: str, write) -> DataFrame:
        """A table written once per session by ``write(path)`` and read back."""
        return self.spark.read.parquet(self.once(name, write))

    def publish(self) -> None:
        with self._lock:
            if not self._published:
                self.raw("raw_stock_prices")
                self.raw("raw_company_metadata")
                build(self.spark, self.root, full_refresh=True)
                self._published = True

    def mart(self, name: str, months: list[str] | None = None) -> DataFrame:
        self.publish()
        return current(self.spark, self.root, name, months)
