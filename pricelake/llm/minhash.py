"""Near-duplicate documents by one-permutation MinHash with optimal densification.

A document's set is its distinct shingles of ``words`` words (a shorter text: its whole sequence as
one).  Every shingle hash falls in one of bands * rows bins and the least of a bin is kept; an
empty bin takes the value of the first filled one in a random order of bins that is its own and the
same for all documents, so that two sets agree in a bin with the probability of their similarity.
Each band of ``rows`` bins is a bucket key.  32 bands of 4 miss a pair of similarity 0.8 with a
probability of 5e-8.

Documents with equal sets are one node (128-bit hash of the set).  In every bucket the node with
the smallest id is the centre and the other nodes are compared with it alone: candidate edges are
stars, as many as bucket entries at most.  A star can miss a link between two nodes of a bucket of
which one fails against the centre.  So the exact rest follows: all buckets of a centre are one
group, and in a group that holds several components every node outside the largest one is compared
with the nodes of the others.  Tiles of two bounded lists of nodes do that in a task each, by
matrix products, and return a spanning forest; pairs are never emitted, no bucket is capped, and
what a star has joined is not paired again.

Links are confirmed on full sets (as 64-bit shingle hashes), which are computed a second time and
only for nodes that share a bucket: a bit table of at most 16 MB, of fixed size, tells the scan
which documents those may be; its false alarms are dropped by the join.

Cases: A-Z is lower-cased, nothing else; a null or wordless text has an empty set and is linked
with nothing (component_id: itself, kept); texts are taken whole; a null doc_id is linked with
nothing (component_id null, kept); rows that share a doc_id are one document, linked by any of
their texts; other columns are ignored, or kept by ``keep_one``; an empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored
from .components import components, spanning
from .textscan import BASE, U, mix, ngram_hashes, pieces, slices, word_bounds, word_hashes

BANDS, ROWS = 32, 4
PROBES = 256
#: Nodes of either list of a tile; shingles of a step of its matrix product.
TILE, STEP = 512, 4096


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, ascending, and the index of each row's first one."""
    starts, ends, first = word_bounds(data, offsets)
    h = word_hashes(data, starts, ends)
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    g, r = [], []
    for k in range(1, words + 1):
        f = ngram_hashes(h, k)
        at = first[:-1][n == k] if k < words else np.flatnonzero(row[:len(f)] == row[words - 1:]) if len(f) else []
        g.append(f[at])
        r.append(row[at])
    g, r = np.concatenate(g), np.concatenate(r)
    if (n[n > 0] < words).any():
        order = np.argsort(r, kind="stable")
        g, r = g[order], r[order]
    bounds = np.searchsorted(r, np.arange(len(n) + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        g[a:b].sort()
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    return g[new], np.searchsorted(r[new], np.arange(len(n) + 1))


def set_keys(g: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hash of each row's set, as two signed 64-bit numbers."""
    out = []
    for seed in (0x8CB92BA72F3D8DD7, 0xABC98388FB8FAC03):
        total = np.zeros(len(g) + 1, U)
        np.cumsum(mix(g ^ U(seed)), out=total[1:])
        out.append(mix(total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


_probe = np.random.default_rng(7).integers(0, BANDS * ROWS, (PROBES, BANDS * ROWS))


def signatures(g: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Densified bins of each row [rows, BANDS * ROWS]; rows with an empty set stay zero."""
    bins, rows = BANDS * ROWS, len(bounds) - 1
    row = np.repeat(np.arange(rows), np.diff(bounds))
    at = row * bins + ((g >> U(32)) * U(bins) >> U(32)).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]       # ascending hashes: the first of a bin is its least
    sig, full = np.zeros(rows * bins, U), np.zeros(rows * bins, bool)
    sig[at[new]], full[at[new]] = g[new], True
    sig, full = sig.reshape(rows, bins), full.reshape(rows, bins)
    filled = full.copy()
    todo = np.flatnonzero(~full.all(1) & full.any(1))
    for probe in _probe:
        if not len(todo):
            break
        take = ~filled[todo] & full[todo][:, probe]
        part = sig[todo]
        part[take] = part[:, probe][take]
        sig[todo] = part
        filled[todo] |= take
        todo = todo[~filled[todo].all(1)]
    for i in todo:                    # the next filled bin to the right
        own = np.flatnonzero(full[i])
        left = np.flatnonzero(~filled[i])
        sig[i, left] = sig[i, own[np.searchsorted(own, left) % len(own)]]
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    """Bucket key of each band [rows, BANDS]."""
    out = np.broadcast_to(np.arange(BANDS, dtype=U) + U(1), (len(sig), BANDS)).copy()
    for k in range(ROWS):
        out = mix(out * U(BASE) + sig[:, k::ROWS])
    return out.view(np.int64)


def _long_lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))


def sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, k1, k2 (hash of the set) and bands of every row."""

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                g, b = shingles(data, offsets, words)
                k1, k2 = set_keys(g, b)
                bands = band_keys(signatures(g, b)).reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(b)), pa.array(k1), pa.array(k2),
                     _long_lists(bands, np.arange(hi - lo + 1) * BANDS)],
                    names=["doc_id", "n_shingles", "k1", "k2", "bands"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_shingles long, k1 long, k2 long, bands array<long>")


#: 64-bit words of a bit table in one part of it.
PART = 1 << 13


def _bit_table(nodes: DataFrame, n: int) -> np.ndarray:
    """Bits set at the hashes of the nodes' ids; between 8 kB and 16 MB, which come to the driver packed
    in up to 256 parts."""
    bits = 1 << min(27, max(16, (16 * n).bit_length()))
    at = F.pmod(F.xxhash64("rep"), F.lit(bits))
    words = (nodes.select(at.alias("at")).groupBy(F.floor(F.col("at") / 64).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
             .withColumn("part", F.floor(F.col("word") / PART)))

    def packed(key, pdf):
        own = np.zeros(PART, np.int64)
        own[pdf["word"].to_numpy() % PART] = pdf["bits"].to_numpy()
        return pd.DataFrame({"part": [key[0]], "bits": [own.tobytes()]})

    out = np.zeros(max(bits // 64, PART), np.int64)
    for r in words.groupBy("part").applyInPandas(packed, "part long, bits binary").collect():
        out[r["part"] * PART:(r["part"] + 1) * PART] = np.frombuffer(r["bits"], np.int64)
    return out[:bits // 64]


def _marked(table: np.ndarray, at: pa.Array) -> np.ndarray:
    at = at.to_numpy()
    return (table[at >> 6] >> (at & 63)) & 1 == 1


def full_sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """rep, k and full set of the given nodes (rep, k), in the shared folder."""
    table = _bit_table(nodes, nodes.count())
    bits = len(table) * 64

    def run(batches):
        for batch in slices(batches):
            batch = batch.filter(pa.array(_marked(table, batch.column(2))))
            for lo, hi, data, offsets in pieces(batch.column(1)):
                g, b = shingles(data, offsets, words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(set_keys(g, b)[0]), _long_lists(g, b)],
                    names=["_rep", "_k", "shingles"])

    found = (docs.where("doc_id is not null")
             .select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(bits)).alias("at"))
             .mapInArrow(run, "_rep long, _k long, shingles array<long>"))
    found = found.join(nodes, (F.col("_rep") == F.col("rep")) & (F.col("_k") == F.col("k")), "left_semi")
    return stored(found.dropDuplicates(["_rep", "_k"]), "minhash-sets")


def _confirm(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (rep, k, rep2, k2) with 100 * intersection >= percent * union: u, v."""
    one = full.select(F.col("_rep").alias("a"), F.col("_k").alias("ak"), F.col("shingles").alias("sa"))
    two = full.select(F.col("_rep").alias("b"), F.col("_k").alias("bk"), F.col("shingles").alias("sb"))
    both = (pairs.join(one, (F.col("rep") == F.col("a")) & (F.col("k") == F.col("ak")))
            .join(two, (F.col("rep2") == F.col("b")) & (F.col("k2") == F.col("bk")))
            .select("rep", "rep2", F.size("sa").alias("na"), F.size("sb").alias("nb"),
                    F.size(F.array_intersect("sa", "sb")).alias("i")))
    return stored(both.where(F.col("i") * 100 >= (F.col("na") + F.col("nb") - F.col("i")) * percent)
                  .select(F.col("rep").alias("u"), F.col("rep2").alias("v")), "minhash-stars")


def _alike(percent: int):
    """Set sizes that leave the similarity possible."""
    return F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(sets(docs, words), "minhash-rows")
    real = rows.where("doc_id is not null and n_shingles > 0")
    # one node per distinct set; copies meet in partial aggregates
    nodes = stored(
        real.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("r"), F.count("*").alias("copies"))
        .select("k1", "k2", F.col("r.doc_id").alias("rep"), F.col("r.n_shingles").alias("n"),
                F.col("r.bands").alias("bands"), "copies"), "minhash-nodes")
    same = (real.join(nodes.where("copies > 1").select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), "rep"),
                      (F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2")))
            .where("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v")))
    entries = nodes.select("rep", F.col("k1").alias("k"), "n", F.explode("bands").alias("b"))
    centres = stored(entries.groupBy("b").agg(F.min(F.struct("rep", "k", "n")).alias("c"), F.count("*").alias("size"))
                     .where("size > 1").select(F.col("b").alias("cb"), F.col("c.rep").alias("rep2"),
                                               F.col("c.k").alias("k2"), F.col("c.n").alias("n2")), "minhash-centres")
    groups = stored(entries.join(centres, F.col("b") == F.col("cb")).select("rep2", "k2", "n2", "rep", "k", "n").distinct(),
                    "minhash-groups")
    full = full_sets(docs, stored(groups.select("rep", "k").distinct(), "minhash-shared"), words)
    different = ~((F.col("rep") == F.col("rep2")) & (F.col("k") == F.col("k2")))
    alike = F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent
    links = _confirm(groups.where(different & alike).select("rep", "k", "rep2", "k2"), full, percent)
    open_ = _open_groups(groups, components(links))
    if not open_.isEmpty():
        links = links.unionAll(_confirm_rest(open_, full, percent))
    classes = stored(components(links.unionAll(same)), "minhash-classes")
    return (rows.join(classes, F.col("doc_id") == F.col("vertex"), "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _open_groups(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """Nodes (rep2, k2, rep, k, c) of the groups with several components, whether each is outside
    the group's largest one, and how many nodes and outside nodes the group has."""
    known = stored(
        groups.join(stored(classes, "minhash-comps"), F.col("rep") == F.col("vertex"), "left")
        .select("rep2", "k2", "rep", "k", F.coalesce("component_id", "rep").alias("c")), "minhash-known")
    sizes = (known.groupBy("rep2", "k2", "c").count().groupBy("rep2", "k2")
             .agg(F.max(F.struct("count", "c")).alias("m"), F.sum("count").alias("all"), F.count("*").alias("parts"))
             .where("parts > 1").select(F.col("rep2").alias("g"), F.col("k2").alias("gk"), F.col("m.c").alias("big"), "all",
                                        (F.col("all") - F.col("m.count")).alias("out")))
    return stored(known.join(stored(sizes, "minhash-sizes"), (F.col("rep2") == F.col("g")) & (F.col("k2") == F.col("gk")))
                  .withColumn("outside", F.col("c") != F.col("big")).drop("g", "gk", "big"), "minhash-open")


def _confirm_rest(open_: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links u, v (a spanning forest of them) between each outside node of a group and the nodes of
    other components there, found on full sets in tiles of at most 2 * TILE nodes."""
    lists = lambda n: F.ceil(F.col(n) / TILE).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    slot = lambda n: F.pmod(F.xxhash64("rep", "k"), n).cast("int")
    left = F.transform(every(lists("all")), lambda j: F.struct(slot(lists("out")).alias("i"), j.alias("j"), F.lit(True).alias("left")))
    right = F.transform(every(lists("out")), lambda i: F.struct(i.alias("i"), slot(lists("all")).alias("j"), F.lit(False).alias("left")))
    tiles = F.explode(F.when(F.col("outside"), F.concat(left, right)).otherwise(right))
    rows = (open_.join(full, (F.col("rep") == F.col("_rep")) & (F.col("k") == F.col("_k")))
            .select("rep2", "k2", "rep", "c", "shingles", tiles.alias("t"))
            .select("rep2", "k2", F.col("t.i").alias("i"), F.col("t.j").alias("j"), F.col("t.left").alias("left"), "rep", "c", "shingles"))
    n = int(open_.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "rep2", "k2", "i", "j").sortWithinPartitions("rep2", "k2", "i", "j")

    def run(batches):
        key, held = None, []
        for batch in batches:
            keys = np.column_stack([batch.column(k).to_numpy() for k in range(4)])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                if key is not None and (keys[a] != key).any():
                    yield spanning_links(held, percent)
                    held = []
                key = keys[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield spanning_links(held, percent)

    return stored(rows.mapInArrow(run, "u long, v long"), "minhash-rest")


def spanning_links(parts: list[pa.RecordBatch], percent: int) -> pa.RecordBatch:
    """u, v: each linked node of a tile and the one that stands for its class there.  Only left
    nodes against right ones of another component are compared.

    Intersections are products of 0/1 matrices over the shingles that both sides have, STEP at a
    time."""
    cat = lambda c: np.concatenate([p.column(c).to_numpy(zero_copy_only=False) for p in parts])
    left, ids, comp = cat("left").astype(bool), cat("rep"), cat("c")
    size = np.concatenate([pc.list_value_length(p.column("shingles")).to_numpy() for p in parts]).astype(np.int64)
    values = np.concatenate([p.column("shingles").flatten().to_numpy() for p in parts])
    row = np.repeat(np.arange(len(ids)), size)
    order = np.argsort(values, kind="stable")
    values, row = values[order], row[order]
    shingle = np.cumsum(np.append(False, values[1:] != values[:-1])) if len(values) else row
    at_left = left[row]
    both = np.zeros(shingle[-1] + 1 if len(shingle) else 0, bool)
    both[shingle[at_left]] = True
    right_too = np.zeros_like(both)
    right_too[shingle[~at_left]] = True
    both &= right_too
    number = np.cumsum(both) - 1
    keep = both[shingle]
    column, row, at_left = number[shingle[keep]], row[keep], at_left[keep]
    place = np.where(left, np.cumsum(left), np.cumsum(~left)) - 1
    a, b = np.flatnonzero(left), np.flatnonzero(~left)
    shared = np.zeros((len(a), len(b)), np.float32)
    bounds = np.searchsorted(column, np.arange(0, both.sum() + STEP, STEP))
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        x, y = np.zeros((len(a), STEP), np.float32), np.zeros((len(b), STEP), np.float32)
        c, r, l = column[lo:hi] % STEP, place[row[lo:hi]], at_left[lo:hi]
        x[r[l], c[l]] = 1
        y[r[~l], c[~l]] = 1
        shared += x @ y.T
    linked = shared * 100 >= (size[a][:, None] + size[b][None] - shared) * percent
    linked &= comp[a][:, None] != comp[b][None]
    i, j = np.nonzero(linked)
    kinds, number = np.unique(ids, return_inverse=True)
    root = spanning(len(kinds), number[a[i]], number[b[j]])
    some = np.flatnonzero(root != np.arange(len(kinds)))
    return pa.RecordBatch.from_arrays([pa.array(kinds[some]), pa.array(kinds[root[some]])], names=["u", "v"])


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is not in ``gone`` (rep).  Only rows that the bit table of
    ``gone`` marks, those that go and a few false alarms, are shuffled with their texts."""
    table = _bit_table(gone, gone.count())
    at = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(len(table) * 64)).alias(fresh(docs, "_at"))

    def side(marked):
        def run(batches):
            for batch in slices(batches):
                keep = _marked(table, batch.column(batch.num_columns - 1)) == marked
                yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).filter(pa.array(keep))
        return docs.select("*", at).mapInArrow(run, docs.schema)

    maybe = side(True)
    name = fresh(docs, "_gone")
    return side(False).unionAll(maybe.join(gone.withColumnRenamed("rep", name), maybe["doc_id"] == F.col(name), "left_anti"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one of each class, all columns kept.  Of rows that share
    the doc_id which stays, one stays; rows with a null doc_id all stay."""
    out = stored(near_duplicates(docs, words, percent), "minhash-out")
    left = _without(docs, stored(out.where("not kept").select(F.col("doc_id").alias("rep")).distinct(), "minhash-gone"))
    name = fresh(docs, "_id")
    again = stored(out.where("kept and doc_id is not null").groupBy(F.col("doc_id").alias(name)).count().where("count > 1"), "minhash-again")
    if again.isEmpty():
        return left
    twice = left.join(again.select(name), left["doc_id"] == F.col(name), "left_semi").dropDuplicates(["doc_id"])
    return left.join(again.select(name), left["doc_id"] == F.col(name), "left_anti").unionAll(twice)


SQL = """
with recursive word as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') as w from documents),
shingle as (
  select distinct doc_id, unnest(case when len(w) >= 4
           then [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]
           when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from word),
size as (select doc_id, count(*) as n from shingle group by doc_id),
links as (
  select a.doc_id as u, b.doc_id as v from shingle a join shingle b on a.s = b.s and a.doc_id <> b.doc_id
  join size p on p.doc_id = a.doc_id join size q on q.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, p.n, q.n having 100 * count(*) >= 80 * (p.n + q.n - count(*))),
reach as (
  select doc_id as u, doc_id as v from documents
  union select r.u, l.v from reach r join links l on r.v = l.u),
least as (select u, min(v) as component_id from reach group by u)
select d.doc_id, coalesce(size.n, 0)::bigint as n_shingles, least.component_id, d.doc_id = least.component_id as kept
from documents d join least on least.u = d.doc_id left join size on size.doc_id = d.doc_id
"""
