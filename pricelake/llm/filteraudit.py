"""Audit of interacting filters by Hart and Mas-Colell's potential.

The filters play a removal game in every part of a table: a coalition's worth is the number of
documents that fail at least one of its filters.  The potential of a coalition is the mean, over its
members, of the potential without that member, with the coalition's worth added; a filter's Shapley
value, its removals averaged over all orders, is the potential of all filters minus the potential
without it.  Potentials are kept as integers (times the factorial of the coalition's size), so the
summed removals of all orders come out exactly.  What a filter removes at a step of an order is the
difference of two coalitions' worths: those before it with and without it.  So no order is ever
run: one pass over the texts gives each document the set of filters that it fails, and all else is
arithmetic on the 2^n worths of a part.

A filter is a condition on the row (``FILTERS``), or DUPLICATE: the text is identical to that of a
smaller doc_id anywhere in the table, removed or not.  Texts meet by SHA-256.  Rows are first
combined by (text, doc_id, part), then by (text, part), so a text with very many copies travels as
few rows per task; the smallest doc_id of each text is joined with those combined rows, never with
documents.  A part is one row of sums.

Cases: a null text is the empty one; a null part is the empty string; a null doc_id is smaller than
none and larger than none, and has no labels; repeated rows count as often as they occur, and rows
that share the smallest doc_id of a text are no duplicates; a document is good (toxic) if any of its
rows of ``labels`` is, and null labels are neither; other columns are ignored, and names cannot
clash; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

WORD = r"[^\x20\x09-\x0D]+"
DUPLICATE = "duplicate"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


#: Letter -> condition under which a text fails, or DUPLICATE.
FILTERS = {
    "A": lambda t: F.size(_words(t)) < 200,
    "B": lambda t: 100 * F.size(F.array_distinct(_words(t))) < 50 * F.size(_words(t)),
    "C": lambda t: 100 * F.regexp_count(t, F.lit("[A-Z]")) > 2 * F.length(t),
    "D": lambda t: t.rlike(r"[#$%&*|]"),
    "E": DUPLICATE,
}


def failures(docs: DataFrame, labels: DataFrame, filters: dict = FILTERS) -> DataFrame:
    """part, failed (bit k: the k-th filter), n, good, toxic: documents of each part by the set of
    filters that they fail."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = {k: f for k, f in enumerate(filters.values()) if f != DUPLICATE}
    mask = sum((F.when(f(F.col("text")), 1 << k).otherwise(0) for k, f in own.items()), F.lit(0))
    again = sum(1 << k for k, f in enumerate(filters.values()) if f == DUPLICATE)
    rows = stored(
        docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
        .select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), mask.alias("failed"))
        .groupBy("digest", "failed", "doc_id", "part").agg(F.count("*").alias("n")), "audit-rows")
    marks = (labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id"))
             .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("_good"),
                  F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("_toxic")).where("_good + _toxic > 0"))
    known = rows.where("doc_id is not null").join(marks, F.col("doc_id") == F.col("_id"), "left")
    none = rows.where("doc_id is null").withColumn("_good", F.lit(0)).withColumn("_toxic", F.lit(0))
    marked = (known.select(*rows.columns, "_good", "_toxic").unionByName(none)
              .withColumn("good", F.col("n") * F.coalesce("_good", F.lit(0))).withColumn("toxic", F.col("n") * F.coalesce("_toxic", F.lit(0))))
    # a part's rows of a text: all, and those of its smallest doc_id there
    texts = stored(
        marked.groupBy("digest", "failed", "part").agg(
            *(F.sum(c).alias(c) for c in ("n", "good", "toxic")), F.min("doc_id").alias("least"),
            F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
            F.min_by(F.struct("n", "good", "toxic"), "doc_id").alias("first")), "audit-texts")
    least = texts.groupBy("digest").agg(F.min("least").alias("_least")).withColumnRenamed("digest", "_digest")
    met = texts.join(least, F.col("digest") == F.col("_digest"))
    holds = F.coalesce(F.col("least") == F.col("_least"), F.lit(False))
    fresh = lambda c: F.when(holds, F.col(f"first.{c}")).otherwise(0)
    kept = F.struct(F.col("failed").alias("failed"), (fresh("n") + F.col("unnamed")).alias("n"), fresh("good").alias("good"), fresh("toxic").alias("toxic"))
    copies = F.struct((F.col("failed") + again).alias("failed"), (F.col("n") - fresh("n") - F.col("unnamed")).alias("n"),
                      (F.col("good") - fresh("good")).alias("good"), (F.col("toxic") - fresh("toxic")).alias("toxic"))
    if not again:       # no filter looks for duplicates
        return texts.groupBy("part", "failed").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))
    return (met.select("part", F.explode(F.array(kept, copies)).alias("x")).select("part", "x.*").where("n > 0")
            .groupBy("part", "failed").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic"))))


def potential(s: int, worth: list[Column], smaller: list[Column]) -> Column:
    """Potential of the coalition ``s`` (a bit set) times the factorial of its size, from its worth
    and the same of the coalitions with one member less."""
    members = [k for k in range(s.bit_length()) if s >> k & 1]
    return sum((smaller[s ^ 1 << k] for k in members), math.factorial(len(members) - 1) * worth[s])


def audit(docs: DataFrame, labels: DataFrame, filters: dict = FILTERS) -> DataFrame:
    """One row per part, order of all filters and step: part, filter_order, step, kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley (removals of the step's filter, summed
    over all orders)."""
    n = len(filters)
    every = (1 << n) - 1
    met = lambda s, c: F.sum(F.when(F.col("failed").bitwiseAND(F.lit(s)) != 0, F.col(c)).otherwise(0))
    worths = failures(docs, labels, filters).groupBy("part").agg(
        F.sum("n").alias("total"), *(F.array(F.lit(0).cast("long"), *(met(s, c) for s in range(1, every + 1))).alias(c)
                                     for c in ("n", "good", "toxic")))
    # a level of coalitions at a time, each one row of columns, so that no expression is repeated
    played = worths
    worth = [F.col("n")[s] for s in range(every + 1)]
    for size in range(1, n + 1):
        level = [s for s in range(every + 1) if s.bit_count() == size]
        by_name = [F.lit(0).cast("long") if s == 0 else F.col(f"q{s}") for s in range(every + 1)]
        played = played.withColumns({f"q{s}": potential(s, worth, by_name) for s in level})
    shapley = F.array(*(F.col(f"q{every}") - n * (F.col(f"q{every ^ 1 << k}") if n > 1 else 0) for k in range(n)))
    steps = []
    for order in itertools.permutations(range(n)):
        before = 0
        name = "".join(list(filters)[k] for k in order)
        for step, k in enumerate(order, 1):
            steps.append(f"struct('{name}' as filter_order, {step} as step, {k} as at, {before} as before, {before | 1 << k} as after)")
            before |= 1 << k
    at = lambda c, s: F.element_at(c, F.col(s) + 1)
    lost = lambda c: at(c, "after") - at(c, "before")
    own = F.element_at("n", F.expr("cast(shiftleft(1, at) as int)") + 1)
    return (played.select("part", "total", "n", "good", "toxic", shapley.alias("shapley"), F.expr(f"explode(array({', '.join(steps)}))").alias("x"))
            .select("part", "total", "n", "good", "toxic", F.col("shapley").alias("values"), "x.*")
            .select("part", "filter_order", "step", (F.col("total") - at("n", "after")).alias("kept"), lost("n").alias("removed"),
                    (own - lost("n")).alias("redundant"),
                    (F.element_at("n", every + 1) - F.element_at("n", F.lit(every) - F.expr("cast(shiftleft(1, at) as int)") + 1)).alias("unique_fails"),
                    lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), at("values", "at").alias("shapley")))


SQL = """
with doc as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
words as (select *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as w, min(doc_id) over (partition by t) as first from doc),
mark as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id),
fails as (
  select part, [len(w) < 200, 100 * list_unique(w) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
                regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > first, false)] as f,
         coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
  from words left join mark using (doc_id)),
grouped as (select part, f, count(*) as n, sum(good) as good, sum(toxic) as toxic from fails group by part, f),
letter as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order from letter a, letter b, letter c, letter d, letter e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps as (select filter_order, step::int as step, [ascii(filter_order[i]) - 64 for i in generate_series(1, 5)] as o
          from orders, generate_series(1, 5) s(step)),
run as (
  select part, filter_order, step, o[step] as own, n, good, toxic, f[o[step]] as fail,
         len(list_filter(o[1:step - 1], lambda k: f[k])) > 0 as gone, len(list_filter(f, lambda b: b)) as failed
  from grouped, steps),
sums as (
  select part, filter_order, step, own,
         coalesce(sum(n) filter (not gone and not fail), 0)::bigint as kept, coalesce(sum(n) filter (fail and not gone), 0)::bigint as removed,
         coalesce(sum(n) filter (fail and gone), 0)::bigint as redundant, coalesce(sum(n) filter (fail and failed = 1), 0)::bigint as unique_fails,
         coalesce(sum(good) filter (fail and not gone), 0)::bigint as good_lost, coalesce(sum(toxic) filter (fail and not gone), 0)::bigint as toxic_lost
  from run group by part, filter_order, step, own)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, own))::bigint as shapley
from sums
"""
