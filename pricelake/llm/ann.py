"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of TABLES tables hashes a vector with m functions floor((a . x + b) / WIDTH), a Gaussian, so
near vectors tend to fall into one bucket or into neighbouring ones.  A query visits, per table,
the ``probes`` buckets with the least sum of squared distances from its own place to the walls that
a step of -1 or +1 per function would cross: the order of estimated success.  The buckets'
vectors are compared with it exactly (inner product in double precision, summed the same way for
every pair), each visit returns its best k, and the tables' candidates are merged.

The largest inner product is the smallest distance once every vector has the same length, so
vectors are scaled by the largest norm of their band and given one more coordinate that fills them
up to 1; queries are scaled to 1 with a last coordinate of 0.  A band holds norms within a factor of
the square root of 2 (the last of BANDS also all smaller ones) and has tables of its own.

m follows the number of vectors of a band: m = log2(n) / 3.5, 3 to 8.  The probes follow the success
seen: SAMPLE queries are compared with all vectors, and a band's probes are as many as find the
share TARGET of the sample's true neighbours in it, m^2 at least; if all 3^m buckets do not, m is
made smaller.  So recall does not depend on the number of vectors or their norms.

A query's candidates are the vectors in the buckets that it visits; queries and vectors meet in one of
two arrangements, which find the same candidates.  By bucket: index and probes are sent to (table,
bucket), where crowded buckets are cut into chunks of vectors and tiles of queries, so a hot bucket
is spread and a task holds one chunk.  By chunk: all tables of a chunk of the index are built in one task,
which takes a tile of queries and merges the candidates of all tables, so each pair is compared
once.  The second costs work on every chunk, the first on every visit; a sample of queries and
vectors tells how many vectors a query meets, and the cheaper one is taken.  Where vectors
have no structure a query meets most of them, and chunks are cheaper; where it meets few, buckets are.

Of equal vectors only the k + 1 smallest ids can be among anyone's best k; the others are left out,
by a limit that Spark applies before the shuffle.  A query that finds fewer than k candidates is
compared with all vectors, chunk by chunk.

Cases: vectors that are null, empty or zero or hold null or non-finite components, and rows with a
null vec_id, take no part; vectors of unlike lengths are not compared; equal scores go to the
smaller vec_id; a query never finds its own vec_id; repeated rows count once; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .vectors import matrix, packed, unpacked, usable

TABLES, WIDTH, CHUNK = 8, 1.5, 4096
BANDS, SAMPLE, TARGET = 16, 64, 0.97
#: Vectors of a chunk and queries of a tile, where tables are built by chunk; vectors of the sample.
SIDE, SEEN = 8192, 8192
#: Seconds (about) of a visit and of a comparison by bucket, of a pair and of a step of probing by chunk.
VISIT_S, PAIR_S, CHUNK_PAIR_S, STEP_S = 1e-5, 6e-8, 3e-8, 1e-7
#: About the rows that the probes of a piece of queries make.
VISITS = 1 << 16


def functions(n: int) -> int:
    """Functions of a table, for n vectors."""
    return min(8, max(3, round(math.log2(max(n, 2)) / 3.5)))


def band(norm: np.ndarray, longest: float) -> np.ndarray:
    """Band of each norm."""
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(2 * np.log2(longest / norm)), 0, BANDS - 1).astype(np.int64)


def filled(x: np.ndarray, norm: np.ndarray, longest: float) -> np.ndarray:
    """Vectors of a band, scaled and filled up to length 1."""
    part = norm / max(longest, 1e-300)
    return np.column_stack([x / max(longest, 1e-300), np.sqrt(np.maximum(1 - part**2, 0))])


def asking(x: np.ndarray) -> np.ndarray:
    """Queries, scaled to length 1."""
    return np.column_stack([x / np.sqrt((x * x).sum(1))[:, None], np.zeros(len(x))])


@lru_cache(maxsize=8)
def family(d: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions [d + 1, TABLES * m] and offsets of all tables, for vectors of d dimensions."""
    rng = np.random.default_rng((d, m))
    return rng.normal(size=(d + 1, TABLES * m)), rng.uniform(0, WIDTH, TABLES * m)


def places(x: np.ndarray, m: int) -> np.ndarray:
    """Place of vectors of length 1 along each function, in bucket widths [rows, TABLES, m]."""
    a, b = family(x.shape[1] - 1, m)
    return ((x @ a + b) / WIDTH).reshape(len(x), TABLES, m)


def bucket(cell: np.ndarray) -> np.ndarray:
    """One number for each cell [.., m]."""
    h = np.zeros(cell.shape[:-1], np.uint64)
    for k in range(cell.shape[-1]):
        h = (h ^ cell[..., k].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _far(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own cells, all steps from them [steps, m], and each step's squared distance [rows, TABLES, steps]."""
    m = place.shape[-1]
    steps = np.array(list(itertools.product((0, -1, 1), repeat=m)))
    cell = np.floor(place)
    part = place - cell
    far = np.zeros((*place.shape[:2], len(steps)))
    for k in range(m):
        wall = np.stack([np.zeros_like(part[..., k]), 1 - part[..., k], part[..., k]], -1)   # by step 0, 1, -1
        far += (wall**2)[..., steps[:, k]]
    return cell, steps, far


def probe(place: np.ndarray, probes: int) -> np.ndarray:
    """Buckets to visit [rows, TABLES, probes], likeliest first."""
    cell, steps, far = _far(place)
    best = np.argsort(far, axis=-1, kind="stable")[..., :probes]
    return bucket(cell[:, :, None, :] + steps[best])


def needed(q: np.ndarray, x: np.ndarray, m: int) -> np.ndarray:
    """Probes after which each filled query finds the filled vector beside it in some table; infinite
    if it is in none of the 3^m buckets."""
    out = [np.zeros(0)]
    for lo in range(0, len(q), 32):
        cell, _, far = _far(places(q[lo:lo + 32], m))
        step = (np.floor(places(x[lo:lo + 32], m)) - cell).astype(np.int64)
        digit = np.where(step == -1, 1, np.where(step == 1, 2, 0))      # the order of the steps
        own = (digit * 3 ** np.arange(m - 1, -1, -1)).sum(-1)
        rank = (far < np.take_along_axis(far, own[..., None], -1)).sum(-1) + 1.0
        out.append(np.where((np.abs(step) <= 1).all(-1), rank, np.inf).min(1))
    return np.concatenate(out)


def settings(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[int, int]:
    """Functions of a table and probes of a query in it, for a band of n vectors, from filled queries
    and the filled neighbours that they should find (a pair of arrays for each length)."""
    for m in range(functions(n), 0, -1):
        need = np.sort(np.concatenate([np.zeros(0), *(needed(q, x, m) for q, x in pairs)]))
        most = need[math.ceil(TARGET * len(need)) - 1] if len(need) else 0
        if np.isfinite(most):
            return m, int(min(max(most, m * m), 3**m))
    return 1, 3


def _by_length(batch: pa.RecordBatch, at: int, limit: int):
    """Parts of the batch with vectors of one length, and that length."""
    lengths = pc.list_value_length(batch.column(at)).to_numpy()
    for d in np.unique(lengths):
        own = batch.filter(pa.array(lengths == d))
        for lo in range(0, len(own), limit):
            yield int(d), own.slice(lo, limit)


class Tables:
    """All tables of some vectors, by band: who is in each bucket."""

    def __init__(self, x: np.ndarray, bands: dict[int, tuple[float, int, int]], longest: float):
        self.n, self.bands, self.held = len(x), bands, []
        norm = np.sqrt((x * x).sum(1))
        own = band(norm, longest)
        for r in np.unique(own):
            most, m, _ = bands[r]
            at = np.flatnonzero(own == r)
            b = bucket(np.floor(places(filled(x[at], norm[at], most), m)))
            self.held.append((r, at, [np.unique(b[:, t], return_inverse=True) for t in range(TABLES)]))

    def candidates(self, q: np.ndarray) -> tuple[np.ndarray, int]:
        """Whether each query (row) visits a bucket of each vector, and how often all of them do."""
        full, met, times = asking(q), np.zeros((len(q), self.n), bool), 0
        for r, at, tables in self.held:
            _, m, probes = self.bands[r]
            asked = probe(places(full, m), probes)
            some = np.zeros((len(q), len(at)), bool)
            for t, (known, inverse) in enumerate(tables):
                place = np.minimum(np.searchsorted(known, asked[:, t]), len(known) - 1)
                row, col = np.nonzero(known[place] == asked[:, t])
                hit = np.zeros((len(q), len(known)), bool)
                hit[row, place[row, col]] = True
                hit = hit[:, inverse]
                times += int(hit.sum())
                some |= hit
            met[:, at] = some
        return met, times


def cheaper_by_chunk(n: int, bands: dict[int, tuple[float, int, int]], share: float, times: float) -> bool:
    """Whether chunks cost less than buckets, for queries that meet ``share`` of n vectors, counting each
    table's meetings ``times`` n."""
    visits = TABLES * sum(probes for _, _, probes in bands.values())
    steps = TABLES * sum(3**m for _, m, _ in bands.values())
    return n * CHUNK_PAIR_S + math.ceil(n / SIDE) * (VISIT_S + steps * STEP_S) <= visits * VISIT_S + times * n * PAIR_S


def best(ids: np.ndarray, x: np.ndarray, own: np.ndarray, q: np.ndarray, k: int, met: np.ndarray | None = None):
    """(query row, id, score) of the k largest inner products of each query (with those it has ``met``)."""
    rough = q @ x.T
    if met is not None:
        rough[~met] = -np.inf
    rough[own[:, None] == ids[None]] = -np.inf
    least = np.partition(rough, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(q), -np.inf)
    slack = 1e-9 * (np.abs(least) + 1)
    slack[~np.isfinite(slack)] = 0
    row, col = np.nonzero((rough >= (least - slack)[:, None]) & (rough > -np.inf))
    score = (q[row] * x[col]).sum(1)
    order = np.lexsort((ids[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    keep = rank < k
    return row[keep], ids[col[keep]], score[keep]


def _true(index: DataFrame, sample: DataFrame, k: int, kind) -> list[tuple[np.ndarray, np.ndarray]]:
    """(queries, vectors) for each length d: the k best of all vectors for each query of the sample,
    pair by pair."""
    asked: dict[int, list] = {}
    for r in sample.collect():          # SAMPLE rows
        asked.setdefault(len(r["embedding"]), []).append((r["vec_id"], r["embedding"]))
    ids = {d: np.array([i for i, _ in v]) for d, v in asked.items()}
    q = {d: np.array([x for _, x in v], np.float64) for d, v in asked.items()}

    def run(batches):
        held = {}
        for batch in batches:
            for d, part in _by_length(batch, 1, 4096):
                if d not in q:
                    continue
                x = matrix(part.column(1))
                score = q[d] @ x.T
                score[ids[d][:, None] == part.column(0).to_numpy()[None]] = -np.inf
                old, vectors = held.get(d, (np.full((len(q[d]), k), -np.inf), np.zeros((len(q[d]), k, d))))
                both = np.concatenate([old, score], 1)
                top = np.argpartition(-both, k - 1, axis=1)[:, :k]
                new = np.where((top < k)[..., None], np.take_along_axis(vectors, np.minimum(top, k - 1)[..., None], 1),
                               x[np.maximum(top - k, 0)])
                held[d] = np.take_along_axis(both, top, 1), new
        for d, (score, vectors) in held.items():
            row, col = np.nonzero(score > -np.inf)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(row), d, np.int32)), pa.array(row), pa.array(score[row, col]), packed(vectors[row, col], kind)],
                names=["d", "q", "score", "vector"])

    order = Window.partitionBy("d", "q").orderBy(F.desc("score"), "vector")
    pairs: dict[int, list] = {}
    for r in (index.mapInArrow(run, "d int, q long, score double, vector binary").withColumn("rank", F.row_number().over(order))
              .where(F.col("rank") <= k).orderBy("d", "q", "rank").collect()):      # SAMPLE * k vectors at most
        pairs.setdefault(r["d"], []).append((r["q"], r["vector"]))
    return [(q[d][[a for a, _ in v]], unpacked([b for _, b in v], kind).astype(np.float64)) for d, v in pairs.items()]


def _bands(index: DataFrame, queries: DataFrame, longest: float, k: int, kind) -> dict[int, tuple[float, int, int]]:
    """Largest norm, functions and probes of each band that holds vectors."""

    def run(batches):
        n, most = np.zeros(BANDS, np.int64), np.zeros(BANDS)
        for batch in batches:
            for _, part in _by_length(batch, 1, 4096):
                x = matrix(part.column(1))
                norm = np.sqrt((x * x).sum(1))
                own = band(norm, longest)
                n += np.bincount(own, minlength=BANDS)
                np.maximum.at(most, own, norm)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BANDS)), pa.array(n), pa.array(most)], names=["band", "n", "most"])

    sizes = (index.mapInArrow(run, "band long, n long, most double").groupBy("band")
             .agg(F.sum("n").alias("n"), F.max("most").alias("most")).where("n > 0").collect())
    pairs = _true(index, queries.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id").limit(SAMPLE), k, kind)
    out = {}
    for r in sorted(sizes):
        found = []
        for q, x in pairs:
            norm = np.sqrt((x * x).sum(1))
            own = band(norm, longest) == r["band"]
            found.append((asking(q[own]), filled(x[own], norm[own], r["most"])))
        out[r["band"]] = (r["most"], *settings(r["n"], found))
    return out


def _share_met(index: DataFrame, queries: DataFrame, n: int, bands, longest: float) -> tuple[float, float]:
    """Share of the vectors that a query meets, and how often in all tables, over n; from samples."""
    asked = queries.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id").limit(SAMPLE).toArrow().combine_chunks()
    part = max(1, -(-n // SEEN))
    some = index.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(part)) == 0).toArrow().combine_chunks()   # about SEEN rows
    met = times = pairs = 0
    for d in pc.unique(pc.list_value_length(asked["embedding"])).to_pylist():
        q, x = (matrix(t.filter(pc.equal(pc.list_value_length(t["embedding"]), d))["embedding"].combine_chunks()) for t in (asked, some))
        if len(q) and len(x):
            found, all_ = Tables(x, bands, longest).candidates(q)
            met, times, pairs = met + int(found.sum()), times + all_, pairs + found.size
    return (met / pairs, times / pairs) if pairs else (0.0, 0.0)


def search(rows: DataFrame, is_query: Column, k: int = 20, by_chunk: bool | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of every row where ``is_query``;
    rows: vec_id, embedding.  ``by_chunk`` sets the arrangement, which changes no result."""
    spark = rows.sparkSession
    kind = np.float64 if "double" in rows.schema["embedding"].dataType.simpleString() else np.float32
    good = stored(rows.select("vec_id", "embedding").where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).distinct(), "ann-rows")
    same = Window.partitionBy("embedding").orderBy("vec_id")
    index = stored(good.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).drop("copy"), "ann-index")
    square = F.aggregate("embedding", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    n, longest = index.agg(F.count("*"), F.max(square)).collect()[0]
    longest = math.sqrt(longest or 1.0) * (1 + 1e-12)
    queries = good.where(is_query).select("vec_id", "embedding")
    bands = _bands(index, queries, longest, k, kind)
    if by_chunk is None:
        by_chunk = cheaper_by_chunk(n, bands, *_share_met(index, queries, n, bands, longest))
    columns = "t int, b long, chunk int, tile int, query boolean, d int, id long, vector binary"
    names = [c.strip().split(" ")[0] for c in columns.split(",")]

    def batch_of(t, b, query, d, ids, vector):
        size = len(t)
        return pa.RecordBatch.from_arrays(
            [pa.array(t.astype(np.int32)), pa.array(b), pa.array(np.zeros(size, np.int32)), pa.array(np.zeros(size, np.int32)), pa.array(np.full(size, query)),
             pa.array(np.full(size, d, np.int32)), ids, vector], names=names)

    def visits(query, vectors):
        def buckets(x):
            """(band, rows, buckets [rows, TABLES, probes]) of each band."""
            norm = np.sqrt((x * x).sum(1))
            if query:
                full = asking(x)
                for r, (_, m, probes) in bands.items():
                    step = max(1, VISITS // (TABLES * probes))
                    for lo in range(0, len(x), step):
                        yield r, np.arange(lo, min(lo + step, len(x))), probe(places(full[lo:lo + step], m), probes)
            else:
                own = band(norm, longest)
                for r in np.unique(own):
                    most, m, _ = bands[r]
                    at = np.flatnonzero(own == r)
                    yield r, at, bucket(np.floor(places(filled(x[at], norm[at], most), m)))[..., None]

        def run(batches):
            for batch in batches:
                for d, part in _by_length(batch, 1, 512):
                    x = matrix(part.column(1))
                    for r, at, b in buckets(x):
                        t = np.broadcast_to(r * TABLES + np.arange(TABLES)[None, :, None], b.shape).reshape(-1)
                        pick = pa.array(np.repeat(at, b.shape[2] * TABLES))
                        vector = packed(x, kind).take(pick) if vectors else pa.nulls(len(pick), pa.binary())
                        yield batch_of(t, b.reshape(-1), query, d, part.column(0).take(pick), vector)
        return run

    def plain(query):
        """Every vector once, to be dealt to chunks and tiles."""
        def run(batches):
            for batch in batches:
                for d, part in _by_length(batch, 1, 4096):
                    zero = np.zeros(len(part), np.int64)
                    yield batch_of(zero, zero, query, d, part.column(0), packed(matrix(part.column(1)), kind))
        return run

    def compare(hashed):
        """Queries against the vectors of their chunk: all, or those that they meet in its tables."""
        def run(batches):
            key, ids, parts, tables = None, [], [], None
            for batch in batches:
                keys = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1, 2, 3, 5, 4)])
                cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
                for a, z in zip([0, *cuts], [*cuts, len(keys)]):
                    if key is None or (keys[a, :5] != key).any():
                        key, ids, parts, tables = keys[a, :5], [], [], None
                    part = batch.slice(a, z - a)
                    vector = unpacked(part.column(7).to_pylist(), kind).astype(np.float64)
                    if not keys[a, 5]:          # vectors of the index come first
                        ids.append(part.column(6).to_numpy())
                        parts.append(vector)
                    elif ids:
                        if len(parts) > 1:
                            ids, parts = [np.concatenate(ids)], [np.concatenate(parts)]
                        tables = Tables(parts[0], bands, longest) if hashed and tables is None else tables
                        own = part.column(6).to_numpy()
                        for lo in range(0, len(own), 256):
                            q = vector[lo:lo + 256]
                            r, i, s = best(ids[0], parts[0], own[lo:lo + 256], q, k, tables and tables.candidates(q)[0])
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(own[lo:lo + 256][r]), pa.array(i), pa.array(s)], names=["query_id", "vec_id", "score"])
        return run

    def met(stock: DataFrame, asked: DataFrame, tasks: int, hashed: bool = False) -> DataFrame:
        both = stock.select(*names).unionAll(asked.select(*names))
        key = ["t", "b", "chunk", "tile", "d"]
        return (both.repartition(tasks, *key).sortWithinPartitions(*key, "query")
                .mapInArrow(compare(hashed), "query_id long, vec_id long, score double"))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    slot = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")

    def in_tiles(asked: DataFrame, hashed: bool) -> DataFrame:
        """All chunks of the index against all tiles of the queries."""
        chunks, tiles = max(1, -(-n // SIDE)), max(1, -(-asked.count() // SIDE))
        stock = index.mapInArrow(plain(False), columns).withColumn("chunk", slot(F.lit(chunks))).withColumn("tile", every(F.lit(tiles)))
        asked = asked.mapInArrow(plain(True), columns).withColumn("tile", slot(F.lit(tiles))).withColumn("chunk", every(F.lit(chunks)))
        return met(stock, asked, max(parts, min(chunks * tiles, 20_000)), hashed)

    if by_chunk:
        pairs = in_tiles(queries, True)
    else:
        cut = lambda df, name: (df.groupBy("t", "b").count()
                                .select(F.col("t").alias("_t"), F.col("b").alias("_b"), F.ceil(F.col("count") / CHUNK).cast("int").alias(name)))
        here = (F.col("t") == F.col("_t")) & (F.col("b") == F.col("_b"))
        counts = stored(cut(index.mapInArrow(visits(False, False), columns), "chunks"), "ann-buckets")
        crowds = stored(cut(queries.mapInArrow(visits(True, False), columns), "tiles").where("tiles > 1"), "ann-crowds")
        one = lambda c: F.coalesce(c, F.lit(1))
        stock = (index.mapInArrow(visits(False, True), columns).join(counts.where("chunks > 1"), here, "left")
                 .withColumn("chunk", slot(one(F.col("chunks")))).select(*names)
                 .join(crowds, here, "left").withColumn("tile", every(one(F.col("tiles")))))
        asked = (queries.mapInArrow(visits(True, True), columns).join(counts, here)
                 .withColumn("chunk", every(F.col("chunks"))).select(*names)
                 .join(crowds, here, "left").withColumn("tile", slot(one(F.col("tiles")))))
        pairs = met(stock, asked, parts)
    found = stored(pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), "ann-found")
    short = stored(queries.join(found.groupBy("query_id").count().where(F.col("count") >= min(k, max(n - 1, 0))),
                                F.col("vec_id") == F.col("query_id"), "left_anti"), "ann-short")
    if not short.isEmpty():
        found = found.unionAll(in_tiles(short, False)).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
