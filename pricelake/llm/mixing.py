"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Every source has a target number of words.  The whole part of target / size is allocated to each
of its documents as certain copies; the rest is a sample of fixed size (in words) without
replacement, with unequal probabilities.  A document's probability follows its importance, a whole
number: by default the number of binary digits of its size, so that longer documents are
favoured, gently.  p = rate * importance, with the rate that makes the expected words of the sample
those still needed; a document whose p would reach 1 is taken for certain, and the rate is solved
again for the others (per source and importance, a running sum over a few rows tells which).

A document has random odds u / (1 - u), with u a hash of its id and text, and its rank is these odds
divided by its inclusion odds p / (1 - p).  Documents are taken in order of rank up to the one nearest
to the target.

No source is sorted.  Its cut is found by sums over 4096 slots of the rank, then over 4096 slots
of the slot where the target falls, and only what is left there (one row in 16 million) is put in
order.  Sums are combined before the shuffle, so a source with a third of all rows is no heavier
than any other.  A document's copies then follow from its own row and its source's cut, so texts
are never shuffled.  One row per source is the only thing that meets in one task or is broadcast,
the latter up to MANY sources; beyond, the cut is joined.

Cases: a null text has size 0, and a size of 0 is never sampled against the target; the null
source is a source of its own, last in order; rows that agree in id and text (repeated rows)
have one rank and share their decision; equal ranks of other rows are decided together as well;
a null id is hashed as an empty one; an importance that is null or under 1 is 1, one over 2^20 is that;
other columns are passed through; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Slots of each of the two passes that look for a source's cut.
SLOTS = 4096
#: Sources up to which the cuts (about 100 bytes each) are broadcast.
MANY = 50_000
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_odds(doc_id: Column, text: Column, seed: str = "") -> Column:
    """u / (1 - u), u from 52 bits of the MD5 of the seed, the id and the text."""
    seen = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"),
                          F.coalesce(text, F.lit(""))).cast("binary"))
    u = (F.conv(F.substring(seen, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))
    return u / (F.lit(1.0) - u)


def targets(sizes: DataFrame, weights=(3, 1, 2), share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """source, source_size -> source, source_size, target.  Sources in order of code point (null
    last) take ``weights`` in turn and share share[0]/share[1] of all sizes; a target stops at
    ``most`` times its size and the excess is shared anew by weight.

    The sources that stop are a prefix in the order of size / weight, so running sums find them."""
    a, b = share
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(turn) - 1) % len(weights) + 1).cast("int"))
    full = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    return (
        sizes.withColumn("w", w.cast("long"))
        .withColumn("total", F.sum("source_size").over(full) * a)
        .withColumn("gone", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * (b * most))
        .withColumn("left", F.sum("w").over(after))
        .withColumn("stops", (F.col("total") - F.col("gone")) * F.col("w") > F.col("source_size") * F.col("left") * (b * most))
        .withColumn("free", F.col("total") - F.sum(F.when(F.col("stops"), F.col("source_size")).otherwise(0)).over(full) * (b * most))
        .withColumn("rest", F.sum(F.when(F.col("stops"), 0).otherwise(F.col("w"))).over(full))
        .select("source", "source_size",
                F.when(F.col("stops"), (F.col("source_size") * most).cast("double"))
                .otherwise((F.col("free") * F.col("w")).cast("double") / (F.col("rest") * b).cast("double"))
                .alias("target")))


def importance_of(size: Column, given: Column | None) -> Column:
    """The given importance as a whole number from 1 to 2^20; by default the binary digits of the size."""
    if given is None:
        return F.length(F.bin(size)).cast("long")
    return F.greatest(F.lit(1), F.least(F.coalesce(given.cast("long"), F.lit(1)), F.lit(1 << 20))).cast("long")


def _cross(rows: DataFrame, slot: str) -> DataFrame:
    """Per source the slot where the running sum of sizes reaches ``need``, and what was summed
    before it.  rows: source, need, size, slot; few slots a source."""
    sums = rows.groupBy("source", "need", slot).agg(F.sum("size").alias("words"))
    run = Window.partitionBy("source").orderBy(slot)
    return (sums.withColumn("through", F.sum("words").over(run))
            .withColumn("before", F.col("through") - F.col("words"))
            .where((F.col("before") < F.col("need")) & (F.col("need") <= F.col("through"))))


def meet(rows: DataFrame, plan: DataFrame, n: int, left: str = "source", how: str = "inner") -> DataFrame:
    """rows joined with the one row of their source; ``n`` is plan's measured number of rows."""
    plan = plan.withColumnRenamed("source", "_plan_source")
    plan = F.broadcast(plan) if n <= MANY else plan
    return rows.join(plan, F.col(left).eqNullSafe(F.col("_plan_source")), how).drop("_plan_source")


def narrow(docs: DataFrame, doc_id="doc_id", text="text", source="source", importance=None, seed="") -> DataFrame:
    """doc_id, source, size, importance and odds of every document, written to the shared folder."""
    given = F.lit(None) if importance is None else F.col(importance)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
                       given.alias("given"), random_odds(F.col(doc_id), F.col(text), seed).alias("odds"))
    return stored(rows.select("doc_id", "source", "size", importance_of(F.col("size"), None if importance is None else F.col("given"))
                              .alias("importance"), "odds"), "mix-rows")


def rates(sizes: DataFrame, goal: DataFrame, n: int) -> DataFrame:
    """source, sure (the least importance that is taken for certain; null if none), fixed (words of
    those), rate (p / importance of the others).  sizes: source, importance, words; goal: source, need.

    From the highest importance down, a level is certain if, with all higher ones taken, the rate of
    the words still needed gives it p >= 1; that rate then excludes all lower levels at once."""
    down = Window.partitionBy("source").orderBy(F.desc("importance"))
    before = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight = F.col("importance") * F.col("words")
    rest = F.sum(weight).over(down.rowsBetween(0, Window.unboundedFollowing))
    certain = (F.col("need") > 0) & ((F.col("need") - before) * F.col("importance") >= rest)
    level = meet(sizes, goal.select("source", "need"), n).withColumn("weight", weight).withColumn("certain", certain)
    return (level.groupBy("source").agg(
        F.first("need").alias("need"), F.min(F.when(F.col("certain"), F.col("importance"))).alias("sure"),
        F.sum(F.when(F.col("certain"), F.col("words")).otherwise(0)).alias("fixed"),
        F.sum(F.when(F.col("certain"), 0).otherwise(F.col("weight"))).alias("weight"))
        .select("source", "sure", "fixed", F.when((F.col("weight") > 0) & (F.col("need") > F.col("fixed")),
                                                  (F.col("need") - F.col("fixed")) / F.col("weight")).otherwise(0.0).alias("rate")))


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` that have met their source's rate, with p and rank of those that are left to chance."""
    sure = F.coalesce(F.col("importance") >= F.col("sure"), F.lit(False))
    p = F.col("rate") * F.col("importance")
    return (rows.withColumn("certain", sure).withColumn("p", F.when(~sure, p))
            .withColumn("rank", F.when(F.col("p") > 0, F.col("odds") / (F.col("p") / (1 - F.col("p"))))))


def cuts(rows: DataFrame, **sharing) -> tuple[DataFrame, int]:
    """One row per source: source_size, target, whole (certain copies), sure and rate (who else is
    certain, and the others' p), and the rank up to which (``take``: itself included) a document
    gets one copy more.  Also their number."""
    sizes = stored(rows.groupBy("source", "importance").agg(F.sum("size").alias("words")), "mix-sizes")
    goal = stored(
        targets(sizes.groupBy("source").agg(F.sum("words").alias("source_size")), **sharing)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
        .withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")), "mix-goal")
    n = goal.count()
    goal = stored(meet(goal, rates(sizes, goal, n), n), "mix-rates")
    slotted = (ranked(meet(rows, goal.where("rate > 0").select("source", "need", "fixed", "sure", "rate"), n)).where("rank is not null")
               .withColumn("need", F.col("need") - F.col("fixed")))
    place = F.col("rank") / (F.lit(1.0) + F.col("rank")) * SLOTS
    slotted = (slotted.withColumn("slot", F.floor(place))
               .withColumn("within", F.floor((place - F.floor(place)) * SLOTS))
               .select("source", "need", "size", "rank", "slot", "within"))
    one = _cross(slotted, "slot").select("source", F.col("slot").alias("slot1"), F.col("before").alias("sum1"))
    inside = (meet(slotted, one, n).where("slot = slot1")
              .withColumn("need", F.col("need") - F.col("sum1")).drop("slot", "slot1"))
    inside = stored(inside, "mix-slot")
    two = _cross(inside, "within").select("source", F.col("within").alias("within1"), F.col("before").alias("sum2"))
    last = (meet(inside, two, n).where("within = within1")
            .withColumn("need", F.col("need") - F.col("sum2")))
    end = _cross(last, "rank").select(
        "source", F.col("rank").alias("cut"),
        (F.col("through") - F.col("need") <= F.col("need") - F.col("before")).alias("take"))
    plan = stored(meet(goal, end, n, how="left"), "mix-cuts")
    return plan, n


def copies() -> Column:
    """Copies of a row that has met its source's cut (see ``ranked``)."""
    more = F.col("certain") | (F.col("rank") < F.col("cut")) | ((F.col("rank") == F.col("cut")) & F.col("take"))
    return F.col("whole") + F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0)


def mix_report(docs: DataFrame, importance=None, seed="", **sharing) -> DataFrame:
    """doc_id, size, source_size, target (both of its source), taken (words) and probability (of the
    copy beyond the whole ones) of every row."""
    rows = narrow(docs, importance=importance, seed=seed)
    plan, n = cuts(rows, **sharing)
    return ranked(meet(rows, plan, n)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies()).cast("long").alias("taken"),
        F.when(F.col("certain"), 1.0).otherwise(F.col("p")).alias("probability"))


def mix(docs: DataFrame, doc_id="doc_id", text="text", source="source", importance=None, seed="", **sharing) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    plan, n = cuts(narrow(docs, doc_id, text, source, importance, seed), **sharing)
    # names of the plan may clash with columns of docs, so the row is carried as one struct
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    given = F.lit(None) if importance is None else F.col(importance)
    key = (docs.select(row, F.col(source).alias("source"), n_words(F.col(text)).alias("size"), given.alias("given"),
                       random_odds(F.col(doc_id), F.col(text), seed).alias("odds"))
           .withColumn("importance", importance_of(F.col("size"), None if importance is None else F.col("given"))))
    return (ranked(meet(key, plan, n)).withColumn("_n", copies()).where("_n > 0")
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy"))
            .select("_row.*"))


SQL = """
with doc as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
         (('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 13))::bigint::double + 0.5)
           / 4503599627370496.0 as u
  from documents),
ranked as (
  select source, sum(size)::bigint as source_size,
         [3, 1, 2][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as w
  from doc group by source),
run as (
  select *, 3 * sum(source_size) over () as total,
         4 * coalesce(sum(source_size) over (order by source_size / w, source nulls last
                      rows between unbounded preceding and 1 preceding), 0) as gone,
         sum(w) over (order by source_size / w, source nulls last
                      rows between current row and unbounded following) as rest
  from ranked),
stop as (select *, (total - gone) * w > 4 * source_size * rest as stops from run),
goal as (
  select source, source_size,
         case when stops then (2 * source_size)::double
              else ((total - 4 * sum(case when stops then source_size else 0 end) over ()) * w)::double
                   / (2 * sum(case when stops then 0 else w end) over ())::double end as target
  from stop),
need as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end as whole,
         target - whole * source_size as need
  from goal),
level as (
  select d.source, length(bin(d.size))::bigint as importance, sum(d.size)::bigint as words, any_value(n.need) as need
  from doc d join need n on d.source is not distinct from n.source group by d.source, length(bin(d.size))),
sure as (
  select source, importance, words, need,
         need > 0 and (need - coalesce(sum(words) over (partition by source order by importance desc
                       rows between unbounded preceding and 1 preceding), 0)) * importance
           >= sum(importance * words) over (partition by source order by importance desc
                                            rows between current row and unbounded following) as certain
  from level),
rate as (
  select source, min(case when certain then importance end) as sure,
         sum(case when certain then words else 0 end)::bigint as fixed,
         sum(case when certain then 0 else importance * words end)::bigint as weight,
         case when weight > 0 and any_value(need) > fixed then (any_value(need) - fixed) / weight else 0.0 end as rate
  from sure group by source),
row as (
  select d.doc_id, d.source, d.size, n.source_size, n.target, n.whole, n.need - r.fixed as need,
         coalesce(length(bin(d.size)) >= r.sure, false) as certain,
         case when not certain then r.rate * length(bin(d.size)) end as p,
         case when p > 0 then (d.u / (1.0 - d.u)) / (p / (1 - p)) end as rank
  from doc d join need n on d.source is not distinct from n.source join rate r on d.source is not distinct from r.source),
sums as (
  select source, need, rank, sum(size) as words from row where rank is not null group by all),
through as (
  select *, sum(words) over (partition by source order by rank) as through, through - words as before from sums),
cut as (
  select source, rank as cut, through - need <= need - before as take from through
  where before < need and need <= through)
select r.doc_id, r.size, r.source_size, r.target,
       (r.size * (r.whole + case when r.certain or r.rank < c.cut or (r.rank = c.cut and c.take) then 1 else 0 end))::bigint as taken,
       case when r.certain then 1.0::double else r.p end as probability
from row r left join cut c on r.source is not distinct from c.source
"""
