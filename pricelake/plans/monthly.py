"""Tables that follow the fact table month by month: figures per ticker, counts of rule violations.

What adds up over months is computed for each month by itself.  ``follow`` keeps such a table under a
manifest that also remembers the folders of the fact table that each month was computed from, and
computes anew only the months whose folders are others now.  So after a day's increment one month
is read, whatever the history, and the read models and the tests below read no fact rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions.scalar import exact_ratio, packed
from pricelake.operators import quality
from pricelake.plans.layers import MONTH
from pricelake.session import small_tasks
from pricelake.sources import manifest
from pricelake.sources.manifest import Manifest
from pricelake.streaming.folders import list_folders

MODEL = "fct_stock_prices"
#: Rule that depends on the day of the test, not only on the rows.
BY_DAY = "no_future_dates"


def follow(spark: SparkSession, table: Manifest, root: str, compute: Callable[[DataFrame], DataFrame]) -> Manifest:
    """The table at ``root``: ``compute`` of every month of ``table``.  ``compute`` gets rows of some months
    with MONTH, and its result has MONTH, by which it must be separable."""
    old = manifest.current(spark, root)
    seen = old.info["source"] if old else {}
    changed = [m for m, folders in table.parts.items() if seen.get(m) != folders]
    if old and not changed and set(seen) == set(table.parts):
        return old
    n = manifest.last(spark, root) + 1
    fact = manifest.read(spark, table, changed).withColumn(MONTH, F.date_format("price_date", "yyyy-MM"))
    rows = compute(fact)
    with small_tasks(spark):
        rows.hint("rebalance", F.col(MONTH)).write.mode("overwrite").partitionBy(MONTH).parquet(f"{root}/v={n}")
    parts = {m: fs for m, fs in (old.parts if old else {}).items() if m in table.parts and m not in changed}
    parts |= {m: [f"v={n}/{MONTH}={m}"] for m in list_folders(spark, f"{root}/v={n}", f"{MONTH}=")}
    return manifest.commit(spark, root, n, parts, rows.drop(MONTH).schema, layer=f"v={n}", source=table.parts)


# --------------------------------------------------------------------------------------------
# Figures of a ticker in a month, and the read models that are sums of them
# --------------------------------------------------------------------------------------------
def figures(fact: DataFrame) -> DataFrame:
    """Per month, ticker and sector: rows, returns, exact sums of the returns (1e-4 units) and of their
    squares, and the volume."""
    u = F.round(F.col("daily_return_pct") * 10000).cast("decimal(38,0)")
    return fact.groupBy(MONTH, "ticker", "sector").agg(
        F.count(F.lit(1)).alias("days"), F.count("daily_return_pct").alias("return_days"),
        F.sum(u).alias("s1"), F.sum(u * u).alias("s2"), F.sum("volume").alias("volume"))


def _mean() -> F.Column:
    return exact_ratio(F.sum("s1"), F.sum("return_days"), 4, 4).alias("avg_daily_return_pct")


def sector_performance(sums: DataFrame) -> DataFrame:
    """``readmodels.sector_performance`` from ``figures``."""
    return sums.groupBy("sector").agg(
        _mean(), F.countDistinct("ticker").alias("tickers"), F.sum("volume").alias("total_volume"),
        F.sum("days").alias("trading_days"))


def risk_return(sums: DataFrame) -> DataFrame:
    """``readmodels.risk_return`` from ``figures``."""
    g = sums.groupBy("ticker").agg(_mean(), F.sum("return_days").alias("return_days"),
                                   F.sum("s1").alias("_s1"), F.sum("s2").alias("_s2"))
    n = F.col("return_days").cast("decimal(38,0)")
    num = (n * F.col("_s2") - F.col("_s1") * F.col("_s1")).cast("double")
    std = F.when(F.col("return_days") > 1, F.round(F.sqrt(num / (n * (n - 1)).cast("double")) / 10000, 4))
    return g.select("ticker", "avg_daily_return_pct", std.alias("stddev_daily_return_pct"), "return_days")


# --------------------------------------------------------------------------------------------
# Violations of the fact table's rules in a month, and the summary that is their sum
# --------------------------------------------------------------------------------------------
def violations(fact: DataFrame) -> DataFrame:
    """Per month, rule and column: failures, those of uniqueness included (a key determines its month)."""
    rules = [x for x in quality.row_rules(MODEL) if x[0] != BY_DAY]
    counts = fact.groupBy(MONTH).agg(*[F.count_if(p).alias(f"r{i}") for i, (_, _, p) in enumerate(rules)])
    rows = ", ".join(f"'{r}', '{c}', r{i}" for i, (r, c, _) in enumerate(rules))
    parts = [counts.selectExpr(MONTH, f"stack({len(rules)}, {rows}) as (rule, column_name, failures)")]
    for c in quality.MODEL_TESTS[MODEL]["unique"]:
        again = (fact.filter(F.col(c).isNotNull()).groupBy(MONTH, packed(c).alias(c)).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
                 .groupBy(MONTH).agg(F.count(F.lit(1)).alias("failures")))
        parts.append(again.select(MONTH, F.lit("unique").alias("rule"), F.lit(c).alias("column_name"), "failures"))
    return reduce(DataFrame.unionByName, parts)


def summary(counts: DataFrame, sums: DataFrame, dim: DataFrame, later: DataFrame, as_of=None, expected=None) -> DataFrame:
    """The tests of the fact table, as ``quality.run_all`` reports them: ``counts`` are its
    ``violations``, ``sums`` its ``figures``; ``later`` are its rows from the month of ``as_of`` on."""
    label = lambda rule, c: (F.lit(MODEL).alias("model"), F.lit(rule).alias("rule"), F.lit(c).alias("column_name"))
    rules = [(r, c) for r, c, _ in quality.row_rules(MODEL) if r != BY_DAY]
    rules += [("unique", c) for c in quality.MODEL_TESTS[MODEL]["unique"]]
    known = counts.sparkSession.createDataFrame([(MODEL, r, c) for r, c in rules], "model string, rule string, column_name string")
    total = counts.groupBy("rule", "column_name").agg(F.sum("failures").alias("failures"))
    parts = [known.join(total, ["rule", "column_name"], "left").select("model", "rule", "column_name", F.coalesce("failures", F.lit(0)).alias("failures"))]
    column = next(c for r, c in quality.FCT_SINGULAR if r == BY_DAY)
    tickers = sums.select("ticker")
    wanted = quality.EXPECTED_TICKERS if expected is None else expected
    for rule, c, rows in [(BY_DAY, column, quality.check_no_future(later, as_of)),
                          ("fct_dim_referential_integrity", "ticker", quality.check_referential(tickers, dim)),
                          ("all_tickers_present", "ticker", quality.check_expected(tickers, wanted))]:
        parts.append(rows.agg(F.count(F.lit(1)).alias("failures")).select(*label(rule, c), "failures"))
    return reduce(DataFrame.unionByName, parts)
