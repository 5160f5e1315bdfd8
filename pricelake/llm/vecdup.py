"""Near-duplicate vectors by a subspace pigeonhole join.

Vectors of length 1 with cosine >= c lie within a squared distance of 2 - 2c.  All are turned by
one random rotation and cut into blocks of a few dimensions; a pair whose blocks all exceeded
their part of the squared distance (in proportion to their dimensions) would exceed the whole, so
every pair is close in at least one block.  Each block is a range join on a grid with cells twice as
wide as the block's radius.  Its first dimensions make the cells that Spark deals out: a vector goes
to its own cell and to those smaller neighbours that it is near enough to reach.  The block's other
dimensions make cells within a cell in the same way, so a task compares only vectors that meet in
every dimension of the block: it compares the vectors that are at home in such a cell with each other
and with the visitors by the whole block distance, keeps a pair only in the first block where it is
close, and confirms it by the cosine of the original vectors in double precision.  So each link is
counted once, and the union of the blocks' candidates never has to be formed.

How many dimensions are dealt out (GRID) follows from the number of vectors: more dimensions make
more visits, fewer make cells that have to be cut.  A hashed sample of up to SAMPLE vectors tells
which number makes the fewest rows; results do not depend on it.  A cell of more than TILE vectors,
as a dense group makes, is cut into chunks, and pairs of chunks are compared in tasks of their own, so
a hot cell is spread and a task holds two chunks at most.  A task returns one row per vector: how
many links, and one vector that it is connected to there; pairs are never emitted.  Equal vectors
(same label and components) are one node with a count.

Rotated coordinates are rounded once to single precision and then taken as given, and the
distance is widened by 1e-5 for it, so the tasks agree on which block is first.

Cases: a vector that is null, empty or zero, or holds null or non-finite components, or whose
label or vec_id is null, is linked with nothing (n_links 0, component_id: its vec_id); vectors of
unlike lengths are not compared; every row is a vector, so a repeated row is linked with its
repetition, and rows that share a vec_id under unlike labels or components have links of their own;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import components, spanning
from .vectors import matrix, packed, unpacked, usable

#: Dimensions of a block, the choice of those dealt out, vectors of a cell compared in one task.
WIDTH, GRID, TILE = 8, (2, 3, 4, 5, 6), 2048
#: Vectors looked at for that choice; pairs compared at once; rows that are not worth cells within a cell.
SAMPLE, PAIRS, FEW = 5_000, 1 << 16, 20
#: Added to the squared distance for rounding.
SLACK = 1e-5
#: Cells beyond TILE up to which their number of chunks is broadcast (32 bytes each).
MANY = 200_000


@lru_cache(maxsize=4)
def rotation(d: int) -> np.ndarray:
    """A random rotation of d dimensions, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def blocks(d: int, width: int) -> list[tuple[int, int]]:
    return [(a, min(a + width, d)) for a in range(0, d, width)]


def budgets(d: int, width: int, least: float) -> np.ndarray:
    """Squared distance allowed to each block."""
    return np.array([(2 - 2 * least + SLACK) * (b - a) / d for a, b in blocks(d, width)])


def reach(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, whether at home, cell numbers) of every visit: ``at`` are places in units of a cell, whose
    half is the distance to reach.  Of the neighbours only smaller ones are visited, so two rows
    within the distance meet in one cell, where one of them at least is at home."""
    home = np.floor(at)
    part = at - home
    rows, moved, off = np.arange(len(at)), np.zeros(len(at), bool), np.zeros(len(at))
    cell = home.astype(np.int64)
    for j in range(at.shape[1]):
        p = part[rows, j]
        down, up = off + p * p, off + (1 - p) ** 2
        ways = [np.arange(len(rows)), np.flatnonzero(down <= 0.25 * (1 + 1e-9)), np.flatnonzero(moved & (up <= 0.25 * (1 + 1e-9)))]
        pick = np.concatenate(ways)
        step = np.repeat(np.array([0, -1, 1]), [len(w) for w in ways])
        off = np.concatenate([off, down[ways[1]], up[ways[2]]])
        rows, moved, cell = rows[pick], moved[pick] | (step != 0), cell[pick]
        cell[:, j] += step
    return rows, ~moved, cell


def rotated(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, turned."""
    return ((x / np.linalg.norm(x, axis=1, keepdims=True)) @ rotation(x.shape[1])).astype(np.float32)


def width_of(budget: float) -> float:
    """Width of a cell: twice the radius."""
    return 2 * float(np.sqrt(budget)) * (1 + 1e-9)


def cells(turned: np.ndarray, width: int, least: float, grid: int):
    """(block, row, is at home, cell numbers [.., grid]) of every visit, a block at a time."""
    d = turned.shape[1]
    for k, ((a, b), budget) in enumerate(zip(blocks(d, width), budgets(d, width, least))):
        g = min(grid, b - a)
        rows, home, cell = reach(turned[:, a:a + g].astype(np.float64) / width_of(budget))
        yield k, rows, home, np.pad(cell, ((0, 0), (0, grid - g)))


def _numbered(cell: np.ndarray) -> np.ndarray:
    """One number per distinct row of cell numbers."""
    key, most = np.zeros(len(cell), np.int64), 1
    for c in cell.T:
        low, n = int(c.min()), int(c.max()) - int(c.min()) + 1
        if most * n >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            most = int(key.max()) + 1
        key, most = key * n + (c - low), most * n
    return key


def meetings(part: np.ndarray, home: np.ndarray, grid: int, budget: float):
    """Pairs (i, j) of rows that meet inside a cell, each pair once, up to about PAIRS at a time.
    ``part``: the rows' coordinates in the block, of which the first ``grid`` made the cell; ``home``:
    who is at home in it.  Of two rows one must be at home there, and one in the cell within."""
    n = len(part)
    if part.shape[1] <= grid or n <= FEW:
        rows, inside, key = np.arange(n), np.ones(n, bool), np.zeros(n, np.int64)
    else:
        rows, inside, cell = reach(part[:, grid:] / width_of(budget))
        key = np.unique(_numbered(cell), return_inverse=True)[1]
    # in each cell within: at home in both, only in the outer, only in the inner, in none
    key = key * 4 + np.where(home[rows], np.where(inside, 0, 1), np.where(inside, 2, 3))
    order = np.argsort(key, kind="stable")
    rows, key = rows[order], key[order]
    here, kind = key - key % 4, key % 4
    third, fourth, end = (np.searchsorted(key, here + k) for k in (2, 3, 4))
    both, outer = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    own = np.concatenate([both, outer])
    low, high = np.concatenate([both + 1, third[outer]]), np.concatenate([end[both], fourth[outer]])
    own, low, high = (x[high > low] for x in (own, low, high))
    through = np.cumsum(high - low)
    lo = 0
    while lo < len(own):
        hi = max(lo + 1, int(np.searchsorted(through, (through[lo - 1] if lo else 0) + PAIRS, side="right")))
        t = (high - low)[lo:hi]
        j = np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t) + np.repeat(low[lo:hi], t)
        yield rows[np.repeat(own[lo:hi], t)], rows[j]
        lo = hi


def _visits(nodes: DataFrame, width: int, least: float, grid: int, vectors: bool) -> DataFrame:
    """A row for every visit of a node (node, n, label, embedding) to a cell."""

    def run(batches):
        for batch in batches:
            lengths = pc.list_value_length(batch.column(3)).to_numpy()
            for d in np.unique(lengths):
                own = batch.filter(pa.array(lengths == d))
                for lo in range(0, len(own), 4096):
                    part = own.slice(lo, 4096)
                    x = matrix(part.column(3))
                    turned = rotated(x)
                    for k, near, home, cell in cells(turned, width, least, grid):
                        pick = pa.array(near)
                        cols = [part.column(2).take(pick), pa.array(np.full(len(near), d, np.int32)),
                                pa.array(np.full(len(near), k, np.int32)),
                                *(pa.array(cell[:, j]) for j in range(grid))]
                        if vectors:
                            cols += [part.column(0).take(pick), part.column(1).take(pick),
                                     pa.array(home), packed(turned[near], np.float32),
                                     packed(x[near], np.float64 if wide else np.float32)]
                        yield pa.RecordBatch.from_arrays(cols, names=names)

    wide = "double" in nodes.schema["embedding"].dataType.simpleString()
    label = nodes.schema["label"].dataType.simpleString()
    schema = f"label {label}, d int, block int" + "".join(f", c{j} long" for j in range(grid))
    if vectors:
        schema += ", node long, n long, home boolean, turned binary, vector binary"
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    return nodes.select("node", "n", "label", "embedding").mapInArrow(run, schema)


def dealt_dimensions(nodes: DataFrame, width: int, least: float) -> int:
    """The number of dimensions of GRID that makes the fewest rows, by a sample: more are tried as long
    as they make fewer."""
    n = nodes.count()
    share = max(1, -(-n // SAMPLE))
    sample = nodes.where(F.pmod(F.xxhash64("node"), F.lit(share)) == 0).select(F.hash("label").alias("label"), "embedding").toArrow()
    best = GRID[0], float("inf")
    for grid in GRID:
        rows = 0.0
        for d in np.unique(pc.list_value_length(sample["embedding"])):
            own = sample.filter(pc.equal(pc.list_value_length(sample["embedding"]), d))
            labels = own["label"].to_numpy()
            for _, near, home, cell in cells(rotated(matrix(own["embedding"].combine_chunks())), width, least, grid):
                key = _numbered(np.column_stack([labels[near].astype(np.int64), cell]))
                _, at, size = np.unique(key, return_inverse=True, return_counts=True)
                # vectors of each visit's cell: those in the sample beside it stand for ``share`` each
                rows += share * float(np.maximum(1, ((size[at] - 1) * share + 1) / TILE).sum())
        if rows >= best[1]:
            break
        best = grid, rows
    return best[0]


def compare(nodes, counts, home, chunk, turned, vector, block: int, grid: int, width: int, least: float, one: bool):
    """Links inside a cell, or between its two chunks: per vector the number of links (weighted by
    the other's copies) and one node that it is connected to here."""
    n, d = turned.shape
    spans = blocks(d, width)
    allowed = budgets(d, width, least)
    a, b = spans[block]
    part = turned[:, a:b].astype(np.float64)
    norm = np.sqrt((vector * vector).sum(1))
    links, root = np.zeros(n, np.int64), np.arange(n)
    edges = allowed * (1 + 1e-9)
    for i, j in meetings(part, home, grid, allowed[block]):
        if not one:
            ok = chunk[i] != chunk[j]
            i, j = i[ok], j[ok]
        ok = ((part[i] - part[j]) ** 2).sum(1) <= edges[block]
        i, j = i[ok], j[ok]
        gap = (turned[i].astype(np.float64) - turned[j]) ** 2
        ok = np.ones(len(i), bool)
        for k, (p, q) in enumerate(spans[:block]):
            ok &= gap[:, p:q].sum(1) > edges[k]
        i, j = i[ok], j[ok]
        ok = (vector[i] * vector[j]).sum(1) / (norm[i] * norm[j]) >= least
        i, j = i[ok], j[ok]
        np.add.at(links, i, counts[j])
        np.add.at(links, j, counts[i])
        root = spanning(n, i, j, root)
    return links, nodes[root]


def near_duplicates(rows: DataFrame, least: float = 0.98, width: int = WIDTH) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``rows`` (vec_id, embedding, label)."""
    rows = rows.select("vec_id", "embedding", "label")
    good = usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    nodes = stored(rows.where(good).groupBy("label", "embedding")
                   .agg(F.min("vec_id").alias("id"), F.count("*").alias("n")), "vec-rows")
    # a number for each: an id may occur under several labels
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "vec-nodes")
    grid = dealt_dimensions(nodes, width, least)
    cell = ["label", "d", "block", *(f"c{j}" for j in range(grid))]
    crowded = stored(_visits(nodes, width, least, grid, False).groupBy(*cell).count().where(F.col("count") > TILE)
                     .withColumn("chunks", F.ceil(F.col("count") / TILE).cast("int")).drop("count"), "vec-crowded")
    crowded = F.broadcast(crowded) if crowded.count() <= MANY else crowded
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1),
                        lambda o: F.struct(F.least(o, F.col("chunk")).alias("i"), F.greatest(o, F.col("chunk")).alias("j")))
    visits = (_visits(nodes, width, least, grid, True).join(crowded, cell, "left")
              .withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("chunk", own)
              .withColumn("tile", F.explode(tiles)).withColumn("i", F.col("tile.i")).withColumn("j", F.col("tile.j")))
    kind = np.float64 if "double" in rows.schema["embedding"].dataType.simpleString() else np.float32

    def run(key, pdf):
        links, root = compare(
            pdf["node"].to_numpy(), pdf["n"].to_numpy(), pdf["home"].to_numpy(bool), pdf["chunk"].to_numpy(),
            unpacked(pdf["turned"], np.float32), unpacked(pdf["vector"], kind).astype(np.float64),
            int(pdf["block"].iloc[0]), grid, width, least, bool((pdf["i"] == pdf["j"]).iloc[0]))
        some = links > 0
        return pd.DataFrame({"node": pdf["node"].to_numpy()[some], "links": links[some], "root": root[some]})

    found = stored(visits.select(*cell, "i", "j", "node", "n", "home", "chunk", "turned", "vector")
                   .groupBy(*cell, "i", "j").applyInPandas(run, "node long, links long, root long"), "vec-links")
    classes = stored(components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
                     .withColumnRenamed("vertex", "_v").withColumnRenamed("component_id", "_class"), "vec-classes")
    totals = found.groupBy(F.col("node").alias("_node")).agg(F.sum("links").alias("links"))
    known = stored(nodes.join(totals, F.col("node") == F.col("_node"), "left").join(classes, F.col("node") == F.col("_v"), "left")
                   .where("n > 1 or links is not null"), "vec-linked")
    least_id = known.groupBy(F.coalesce("_class", "node").alias("_group")).agg(F.min("id").alias("class"))
    known = stored(known.join(least_id, F.coalesce("_class", "node") == F.col("_group"))
                   .select(F.col("label").alias("_label"), F.col("embedding").alias("_embedding"),
                           (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("more"), "class"), "vec-known")
    linked = (rows.where(good).join(known, (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding")), "left")
              .select("vec_id", "more", "class"))
    alone = rows.where(~good).select("vec_id", F.lit(None).cast("long").alias("more"), F.lit(None).cast("long").alias("class"))
    return (linked.unionAll(alone)
            .select("vec_id", F.coalesce("more", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("class", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


SQL = """
with recursive numbered as (select row_number() over () as r, vec_id, label, embedding from embeddings),
good as (
  select r, vec_id, label, embedding::double[] as x from numbered
  where label is not null and vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda c: c is null or isnan(c) or isinf(c))) = 0
    and len(list_filter(embedding, lambda c: c <> 0)) > 0),
links as (
  select a.r as u, b.r as v from good a join good b
    on a.label = b.label and len(a.x) = len(b.x) and a.r <> b.r
  where list_inner_product(a.x, b.x) / (sqrt(list_inner_product(a.x, a.x)) * sqrt(list_inner_product(b.x, b.x))) >= 0.98),
reach as (
  select r as u, r as v from numbered
  union select r.u, l.v from reach r join links l on r.v = l.u),
least as (select u, min(vec_id) as component_id from reach join numbered on v = r group by u),
n as (select u, count(*) as n_links from links group by u)
select e.vec_id, coalesce(n.n_links, 0)::bigint as n_links, least.component_id, e.vec_id is not distinct from least.component_id as kept
from numbered e join least on least.u = e.r left join n on n.u = e.r
"""
