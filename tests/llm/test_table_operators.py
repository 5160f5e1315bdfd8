"""Operators on vectors, sets, sources and archives against plain code, and the pipeline."""

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from pricelake.llm import ann, components, files, langid, minhash, mixing, queries, vecdup, warc
from pricelake.llm.common import ship, stored, table
from pricelake.session import scratch_path

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def classes(ids, links):
    """Smallest member of each id's class."""
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


# --- components -----------------------------------------------------------------------------

def test_components_of_paths_stars_and_cliques(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(500, 600 + i) for i in range(50)] + [(900 + i, 900 + j) for i in range(6) for j in range(i)]
    links += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    links = [p if rng.random() < 0.5 else p[::-1] for p in links] + links[:5]
    got = components.components(spark.createDataFrame(links, "u long, v long")).collect()
    want = classes({x for p in links for x in p}, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert dict(map(tuple, got)) == {i: c for i, c in want.items() if i in linked} and len(got) == len(linked)
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- near-duplicate documents ---------------------------------------------------------------

def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def expected_classes(rows, n, percent=80):
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k]
             if x and y and a != b and 100 * len(x & y) >= percent * len(x | y)]
    return classes({i for i, _ in sets}, links)


def check_near(spark, rows, n):
    docs = spark.createDataFrame([(*r, "x", 1, 2, 3, 4) for r in rows], "doc_id long, text string, rep string, u int, _gone int, _id int, _at int")
    got = minhash.near_duplicates(docs, words=n).collect()
    want = expected_classes(rows, n)
    assert sorted((str(r["doc_id"]), r["n_shingles"]) for r in got) == sorted((str(i), len(shingles(t, n))) for i, t in rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
    return docs, got


def test_near_duplicates_of_odd_rows(spark):
    base = [f"w{i}" for i in range(100)]
    edit = lambda *at: " ".join("zz" if i in at else w for i, w in enumerate(base))
    rows = [(5, edit()), (3, edit()), (9, edit(4)), (8, edit(4, 50)), (7, edit(4, 50, 90)), (2, edit(*range(0, 100, 7))),
            (11, None), (12, ""), (13, " \n"), (14, "One two"), (15, "one  TWO"), (16, "one two three"), (17, "one"),
            (None, edit()), (None, None), (20, edit()), (20, edit()), (21, "a b c d e"), (22, "a b c d e f"),
            (30, "p q " * 4000), (31, "p q " * 5000), (32, "Á b c d e"), (33, "á b c d e"),
            (40, "same id other text one two three four"), (40, "a b c d e f")]
    docs, got = check_near(spark, rows, 4)
    left = minhash.keep_one(docs, words=4)
    assert left.columns == docs.columns
    kept = [r["doc_id"] for r in left.collect()]
    assert sorted(i for i in kept if i is not None) == sorted({r["doc_id"] for r in got if r["kept"] and r["doc_id"] is not None})
    assert kept.count(None) == 2
    empty = minhash.near_duplicates(docs.limit(0))
    assert empty.count() == 0 and minhash.keep_one(docs.limit(0)).count() == 0


def test_group_whose_star_misses_links(spark, monkeypatch):
    """Many copies with random edits: most pairs are close to 0.8 on either side."""
    monkeypatch.setattr(minhash, "TILE", 16)        # several tiles
    rng = random.Random(1)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for k in range(120):
        words = list(base)
        for i in rng.sample(range(150), rng.randint(1, 12)):
            words[i] = f"x{rng.randint(0, 3)}"
        rows.append((1000 - k, " ".join(words)))
    check_near(spark, rows, 4)


def test_near_duplicates_of_given_documents(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = minhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == expected_classes(rows, 5)


# --- near-duplicate vectors -----------------------------------------------------------------

def vector_rows(rng, d=16):
    rows, n = [], 0
    for g in range(12):
        centre = rng.normal(size=d)
        for _ in range(rng.integers(1, 30)):
            rows.append((n, (centre + rng.normal(size=d) * rng.choice([0.0, 0.05, 0.15])).tolist(), int(g % 3)))
            n += 1
    good = rows[0][1]
    rows += [(n, [2 * x for x in good], 0), (n + 1, good, None), (n + 2, None, 0), (n + 3, [0.0] * d, 0), (n + 4, good[:-1] + [None], 0),
             (n + 5, good[:-1] + [float("nan")], 0), (n + 6, good[:-1] + [float("inf")], 0), (n + 7, [], 0), (None, good, 0),
             (n + 8, good[:4], 0), (n + 9, good[:4], 0), (n + 10, good, 1), rows[0]]
    return rows


def valid(v):
    return bool(v) and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)


@pytest.mark.parametrize("kind, tile, width", [("float", 2048, 8), ("double", 8, 3)])
def test_vector_links(spark, monkeypatch, kind, tile, width):
    monkeypatch.setattr(vecdup, "TILE", tile)
    rows = vector_rows(np.random.default_rng(4))
    if kind == "float":
        rows = [(i, v and [x if x is None else float(np.float32(x)) for x in v], c) for i, v, c in rows]
    data = spark.createDataFrame([(*r, 1, "y") for r in rows], f"vec_id long, embedding array<{kind}>, label int, n int, d string")
    got = vecdup.near_duplicates(data, width=width).collect()
    links, count = [], defaultdict(int)
    for a, (i, v, c) in enumerate(rows):
        for j, w, e in rows[:a]:
            if i is not None and j is not None and c is not None and c == e and valid(v) and valid(w) and len(v) == len(w):
                if np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
                    links.append((i, j))
                    count[a] += 1
                    count[rows.index((j, w, e))] += 1
    want = classes({i for i, _, _ in rows if i is not None}, links)
    n = {i: count[k] for k, (i, _, _) in enumerate(rows) if i is not None}
    n[0] = count[0]
    assert len(got) == len(rows)
    for r in got:
        if r["vec_id"] is None:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, None, True)
        else:
            assert (r["component_id"], r["kept"]) == (want[r["vec_id"]], want[r["vec_id"]] == r["vec_id"])
            if r["vec_id"]:                 # the repeated row 0 is linked with itself as well
                assert r["n_links"] == n[r["vec_id"]], r
    assert vecdup.near_duplicates(data.limit(0)).count() == 0


def test_an_id_under_two_labels(spark):
    v = [[1.0, x, 0.0, 0.0] for x in (0.0, 0.1, 0.6)]
    rows = [(5, v[0], "A"), (6, v[0], "A"), (7, v[1], "A"), (5, v[0], "B"), (5, [0.0, 1.0, 0.0, 0.0], "A"), (9, v[2], "B"), (3, v[2], "B")]
    got = vecdup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    # (5, A) is linked with 6 and 7; (5, B) and the other vector of 5 with nothing; 9 and 3 with each other
    assert sorted(map(tuple, got)) == [(3, 1, 3, True), (5, 0, 5, True), (5, 0, 5, True), (5, 2, 5, True), (6, 2, 5, False), (7, 2, 5, False), (9, 1, 3, False)]


@pytest.mark.parametrize("n, grid", [(2000, 2), (8000, 2), (8000, 4)])
def test_few_pairs_of_random_vectors_are_compared(n, grid):
    x = np.random.default_rng(n).normal(size=(n, 64))
    turned, pairs = vecdup.rotated(x), 0
    allowed = vecdup.budgets(64, 8, 0.98)
    for k, rows, home, cell in vecdup.cells(turned, 8, 0.98, grid):
        key = vecdup._numbered(cell)
        order = np.argsort(key)
        for own in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
            part = turned[rows[own], 8 * k:8 * k + 8].astype(float)
            pairs += sum(len(i) for i, _ in vecdup.meetings(part, home[own], grid, allowed[k]))
    assert pairs < 0.05 * n * (n - 1) / 2


@pytest.mark.parametrize("d", [1, 3, 6])
def test_rows_within_reach_meet_once(d):
    x = np.random.default_rng(d).uniform(-2, 2, (300, d))
    met = defaultdict(int)
    for both in vecdup.meetings(x, np.ones(300, bool), 0, 0.3):
        for i, j in zip(*both):
            met[min(i, j), max(i, j)] += 1
    near = {(i, j) for j in range(300) for i in range(j) if ((x[i] - x[j]) ** 2).sum() <= 0.3}
    assert near <= set(met) and set(met.values()) == {1}


def test_dealt_dimensions_grow_with_the_vectors(spark, monkeypatch):
    ship(spark)
    rng = np.random.default_rng(1)
    nodes = spark.createDataFrame([(k, "a", rng.normal(size=64).tolist()) for k in range(2000)], "node long, label string, embedding array<double>")
    few = vecdup.dealt_dimensions(nodes, 8, 0.98)
    monkeypatch.setattr(vecdup, "TILE", 4)
    assert vecdup.dealt_dimensions(nodes, 8, 0.98) > few == 2


# --- nearest neighbours ---------------------------------------------------------------------

def nearest(rows, is_query, k):
    good = {}
    for i, v in rows:
        if i is not None and valid(v):
            good.setdefault(i, []).append(v)
    out = {}
    for i in filter(is_query, good):
        best = {j: max(float(np.dot(a, b)) for a in good[i] for b in vs) for j, vs in good.items() if j != i and len(vs[0]) == len(good[i][0])}
        out[i] = sorted(best.items(), key=lambda p: (-p[1], p[0]))[:k]
    return out


@pytest.mark.parametrize("by_chunk", [False, True])
def test_nearest_of_odd_rows(spark, monkeypatch, by_chunk):
    monkeypatch.setattr(ann, "CHUNK", 16)
    monkeypatch.setattr(ann, "SIDE", 16)
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=8) * rng.choice([0.5, 1, 3])).tolist()) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(40)] + [(200, None), (220, [0.0] * 8), (240, [float("nan")] * 8), (None, rows[0][1]),
                                                         (260, [1.0, 2.0]), (261, [2.0, 1.0]), rows[4]]
    data = spark.createDataFrame([(*r, 0, 0) for r in rows], "vec_id long, embedding array<double>, t int, score int")
    got = defaultdict(list)
    for r in sorted(ann.search(data, F.col("vec_id") % 20 == 0, 5, by_chunk).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    want = nearest(rows, lambda i: i % 20 == 0, 5)
    assert set(got) == {i for i in want if want[i]}
    found = total = 0
    for i, best in got.items():
        assert len(best) == len(want[i]) and i not in dict(best) and best == sorted(best, key=lambda p: (-p[1], p[0]))
        scores = dict(nearest(rows, lambda j, i=i: j == i, 10**6)[i])
        assert all(abs(scores[j] - s) < 1e-9 for j, s in best)
        found += len(set(dict(best)) & set(dict(want[i])))
        total += len(best)
    assert found >= 0.9 * total
    assert ann.search(data.limit(0), F.col("vec_id") % 20 == 0, by_chunk=by_chunk).count() == 0


def test_both_arrangements_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK", 64)
    monkeypatch.setattr(ann, "SIDE", 128)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(30, 24))
    x = centres[rng.integers(0, 30, 1500)] + rng.normal(size=(1500, 24)) * 0.2
    x[:400] = centres[0] + rng.normal(size=(400, 24)) * 0.01        # a hot bucket, on both sides
    data = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    both = [sorted(map(str, ann.search(data, F.col("vec_id") % 3 == 0, 7, by_chunk).collect())) for by_chunk in (False, True)]
    assert both[0] == both[1] and len(both[0]) == 500 * 7


def test_queries_meet_fewer_than_all_vectors():
    """Uniform vectors: each pair is compared once, so a query never makes n comparisons; by buckets
    alone it would make more."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 64))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    bands = {0: (1.0, 4, 25)}
    met, times = ann.Tables(x, bands, 1.0 + 1e-12).candidates(x[:50])
    assert met.sum() < 50 * 4000 and times > met.sum()
    assert ann.cheaper_by_chunk(100_000, {0: (1.0, 5, 60)}, 0.8, 1.8) and not ann.cheaper_by_chunk(100_000_000, {0: (1.0, 8, 64)}, 1e-5, 2e-5)


def test_nearest_of_few_vectors_is_all_of_them(spark):
    rows = [(i, [float(i + 1), 1.0, -float(i)]) for i in range(7)]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") >= 0, 20).collect()
    want = nearest(rows, lambda i: True, 20)
    assert {(r["query_id"], r["rank"]): r["vec_id"] for r in got} == {(i, k + 1): j for i, b in want.items() for k, (j, _) in enumerate(b)}


def test_recall_on_given_vectors(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in table(spark, "/root/testdata/sf0.1", "embeddings").collect()]
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    got = queries.QUERIES["op5_nearest"](spark, "/root/testdata/sf0.1").toPandas()
    hit = 0
    for i in ids[ids % 20 == 0]:
        s = (x * x[ids == i]).sum(1)
        s[ids == i] = -9
        hit += len(set(got.vec_id[got.query_id == i]) & set(ids[np.lexsort((ids, -s))[:20]]))
    assert len(got) == 20 * (ids % 20 == 0).sum() and hit >= 0.9 * len(got)


def test_probes_follow_the_success_seen():
    rng = np.random.default_rng(6)
    q, y = rng.normal(size=(2, 300, 64))
    q /= np.sqrt((q * q).sum(1, keepdims=True))
    y -= (y * q).sum(1, keepdims=True) * q
    x = 0.55 * q + math.sqrt(1 - 0.55**2) * y / np.sqrt((y * y).sum(1, keepdims=True))
    full = ann.asking(q), ann.asking(x)
    m, probes = ann.settings(200_000_000, [full])
    assert (ann.needed(*full, m) <= probes).mean() >= 0.97
    assert (ann.needed(*full, 8) <= 64).mean() < 0.9        # m^2 probes of 8 functions do not find them


@pytest.mark.parametrize("norms", ["one long", "lognormal"])
def test_recall_with_unequal_norms(spark, norms):
    rng = np.random.default_rng(11)
    n = 20_000
    x = rng.normal(size=(n, 64))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    if norms == "one long":
        x[7] *= 6
    else:
        x *= rng.lognormal(0, 0.8, (n, 1))
    x = x.astype(np.float32)
    data = spark.createDataFrame(pa.table({"vec_id": pa.array(np.arange(n)), "embedding": pa.array(list(x), pa.list_(pa.float32()))}))
    got = ann.search(data, F.col("vec_id") % 100 == 0, 20).toPandas()
    s = x[::100].astype(float) @ x.T.astype(float)
    s[np.arange(200), np.arange(0, n, 100)] = -9
    want = {(100 * i, j) for i, row in enumerate(np.argsort(-s, axis=1)[:, :20]) for j in row}
    assert len(got) == 4000 and len(want & set(zip(got.query_id, got.vec_id))) >= 0.94 * len(want)


# --- mixing ---------------------------------------------------------------------------------

def water(sizes, share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: unit * weight[s] for s in free}
        target |= {s: float(most * sizes[s]) for s in over}
        left -= sum(target[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("seed", [0, 1])
def test_mix(spark, seed):
    rng = random.Random(seed)
    sources = [None, "b", "a", "ä", "Z", "only empty"]
    rows = [(i, " ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(0, 40))), rng.choices(sources[:5], [1, 9, 2, 2, 1])[0]) for i in range(600)]
    rows += [(700, None, "a"), (701, "", "only empty"), (None, "one two", "b"), (None, None, None), rows[0], (702, "x " * 20000, "b")]
    docs = spark.createDataFrame([(*r, 5, 6.0) for r in rows], "doc_id long, text string, source string, size int, odds double")
    n = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += n(t)
    want = water(sizes)
    got = mixing.mix_report(docs).collect()
    again = mixing.mix_report(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    by = defaultdict(list)
    source = {(i, n(t)): s for i, t, s in rows}
    for r in got:
        s = source[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        by[s].append(r["taken"])
    for s, taken in by.items():
        assert abs(sum(taken) - want[s]) <= max(n(t) for _, t, x in rows if x == s) / 2 + 1e-6
    mix = mixing.mix(docs)
    assert mix.columns == docs.columns
    assert sum(n(r["text"]) for r in mix.collect()) == sum(r["taken"] for r in got)
    weighted = mixing.mix(docs, importance="size")
    assert weighted.columns == docs.columns
    assert sum(n(r["text"]) for r in weighted.collect()) == sum(r["taken"] for r in mixing.mix_report(docs, importance="size").collect())
    assert mixing.mix_report(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def inclusion(rows, need):
    """p of each (importance, size): proportional to importance, those of 1 and more certain."""
    sure = set()
    while True:
        free = [k for k in range(len(rows)) if k not in sure]
        left = need - sum(rows[k][1] for k in sure)
        weight = sum(rows[k][0] * rows[k][1] for k in free)
        over = {k for k in free if left * rows[k][0] >= weight}
        if not over:
            return [1.0 if k in sure else max(left, 0) / weight * rows[k][0] for k in range(len(rows))]
        sure |= over


@pytest.mark.parametrize("importance", [[1, 1, 1, 2, 2, 3, 5, 8], [40, 30, 1, 1, 1, 1, 2, 2], [7] * 8])
def test_inclusion_probabilities(spark, importance):
    """300 sources with the same documents and targets: how often each document is taken."""
    sizes, sources = [30, 12, 25, 8, 30, 14, 20, 11], 300
    rows = [(100 * s + k, "w " * n, f"s{s:03d}", i) for s in range(sources) for k, (n, i) in enumerate(zip(sizes, importance))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, i int")
    got = mixing.mix_report(docs, importance="i", weights=(1,), share=(1, 2)).collect()
    assert {r["target"] for r in got} == {75.0} and all(abs(r["target"] - 75) <= 15 for r in got)
    p = inclusion(list(zip(importance, sizes)), 75.0)
    taken = [0] * 8
    for r in got:
        assert r["probability"] == pytest.approx(p[r["doc_id"] % 100])
        taken[r["doc_id"] % 100] += r["taken"] > 0
    for k in range(8):
        assert (taken[k] == sources) if p[k] == 1 else abs(taken[k] / sources - p[k]) < 0.12, (k, p, taken)
    other = mixing.mix_report(docs, importance="i", weights=(1,), share=(1, 2), seed="x").collect()
    assert sorted(map(str, got)) != sorted(map(str, other))


def test_mix_without_python(spark):
    plan = mixing.mix(table(spark, SF, "documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- archives -------------------------------------------------------------------------------

def test_archives_with_records_inside_payloads(spark):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nX-Page-ID: 99\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    long = "y" * 150
    pages = [(1, "http://a/\r\nX-Page-ID: 7", inner * 3), (2, None, None), (3, "u", ""), (4, "u", "short"), (5, "u", "short"),
             (9, "u", long), (6, "u", long), (8, "u", long), (10, "u", "é" * 50), (11, "u", "é" * 50), (12, "u", "WARC/1.1\r\n" * 400),
             (13, "u", "z" * 30000), (None, "u", long), (None, "u", "k" * 120), (None, "u", "k" * 120), (14, "u", inner + long), (15, "u", "\r\n\r\n" * 60),
             (6, "u", long)]
    data = spark.createDataFrame([(*p, "c", 1) for p in pages], "page_id long, url string, html string, digest string, size int").repartition(3)
    folder = scratch_path(spark, "test-warc")
    warc.write(data, folder)
    first = {}
    for i, _, h in pages:
        h = (h or "").encode()
        if len(h) >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    want = sorted(str((i, len(b), hashlib.sha256(b).hexdigest(), *(("revisit", first[b]) if first.get(b, i) != i else ("response", None))))
                  for i, b in ((i, (h or "").encode()) for i, _, h in pages))
    for size in (64, 1000, 1 << 22):
        records = warc.read_records(spark, folder, size)
        assert sorted(str(tuple(r)) for r in warc.digest_report(records).collect()) == want
    assert {r["uri"] for r in records.collect()} == {"http://a/  X-Page-ID: 7", None, "u"}
    warc.write(data.limit(0), folder + "-empty")
    assert warc.read_records(spark, folder + "-empty").count() == 0


def test_archive_with_a_header_longer_than_a_block(spark):
    pages = [(i, "u" * (300_000 if i in (3, 8) else 20), f"page {i} " * 30) for i in range(12)]
    folder = scratch_path(spark, "test-warc-long")
    warc.write(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1), folder)
    for size in (50_000,):
        got = warc.read_records(spark, folder, size).collect()
        assert sorted((r["page_id"], r["uri"], r["payload"].decode()) for r in got) == pages


def test_file_that_is_no_archive(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes(b"rubbish WARC/1.1\r\nContent-Length: 1\r\n\r\na\r\n\r\n")
    (tmp_path / "y.txt").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 1\r\n\r\na\r\n\r\ncut WARC/1.1\r\nContent-Length: 900\r\n\r\nb")
    assert [(r["path"][-5:], r["payload"]) for r in warc.read_records(spark, str(tmp_path), 16).collect()] == [("y.txt", b"a")]
    with pytest.raises(ValueError, match="2 broken files"):
        warc.read_records(spark, str(tmp_path), 16, strict=True)


def in_order(data):
    """(place, content) of every whole record from the start on, how far they go, and whether to the end."""
    out, at = [], 0
    while data.startswith(warc.VERSION, at) and (found := warc.header(data, at)):
        end = found[1] + int(found[0]["content-length"])
        if end > len(data):
            break
        out.append((at, data[found[1]:end]))
        at = min(end + 4, len(data))
        if end + 4 > len(data):
            return out, end, False
    return out, at, at == len(data)


@pytest.mark.parametrize("size", [64, 700, 4096, 4 << 20])
def test_broken_archives(spark, tmp_path, size):
    record = lambda k, n: (b"WARC/1.1\r\nWARC-Type: resource\r\nX-Page-ID: %d\r\nContent-Length: %d\r\n\r\n" % (k, n)
                           + (b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * n)[:n] + b"\r\n\r\n")
    some = [record(k, k * 7 % 90) for k in range(150)]
    whole = b"".join(some)
    made = {"whole": whole, "mark-cut": whole[:-1], "content-cut": whole[:-10], "header-cut": whole[:-len(some[-1]) + 20], "junk": whole + b"junk",
             "blank": whole + b"\r\n", "middle": b"".join(some[:70]) + b"??" + b"".join(some[70:]), "start": b"?" + whole,
             "long": record(1, 9000) + whole + record(2, 20), "wrong-length": b"".join(some[:40]) + some[40].replace(b"Length: 10", b"Length: 11") + b"".join(some[41:])}
    for name, data in made.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "empty").write_bytes(b"")
    got = defaultdict(list)
    for r in warc.read_records(spark, str(tmp_path), size).collect():
        got[r["path"].rsplit("/", 1)[1]].append((r["place"], r["payload"]))
    report = {r["path"].rsplit("/", 1)[1]: (r["read_to"], r["whole"])
              for r in warc.file_report(spark, str(tmp_path), warc.entries(spark, str(tmp_path), size)).collect()}
    for name, data in made.items():
        records, to, ok = in_order(data)
        assert sorted(got[name]) == records, name
        assert report[name] == (to, ok), name
    assert {n for n, x in report.items() if x[1]} == {"whole", "long"}


def test_every_block_is_a_task(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"f{k}").write_bytes(bytes(10_000 + k))
    found = files.blocks(spark, str(tmp_path), 500)
    assert found.rdd.getNumPartitions() == 20 + 21 + 21
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 62 and max(sizes) <= 4 and len(sizes) >= 40


# --- pipeline -------------------------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    given = {r["doc_id"]: r for r in docs.collect()}
    known = stored(corpus_pipeline.known_language(spark, docs, SF), "t")
    left = {r["doc_id"] for r in known.collect()}
    assert known.columns == docs.columns and len(left) >= 0.98 * len(given)
    names, _, kept = langid.identify([given[i]["text"] for i in sorted(given)], langid.learn(docs))
    assert left == {i for i, k in zip(sorted(given), kept) if k}
    good = stored(corpus_pipeline.good_quality(spark, known, SF), "t")
    left = {r["doc_id"] for r in good.collect()}
    marks = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    assert [i for i in marks if i in {r["doc_id"] for r in known.collect()} and (marks[i] == 1) != (i in left)] == []
    one = stored(corpus_pipeline.one_of_each(spark, good, SF), "t")
    want = expected_classes([(i, given[i]["text"]) for i in left], 5)
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(set(want.values()))
    mixed = stored(corpus_pipeline.mixed(spark, one, SF), "t")
    assert mixed.columns == docs.columns
    taken = pd.Series([r["doc_id"] for r in mixed.collect()]).value_counts()
    report = mixing.mix_report(one).collect()
    assert {r["doc_id"]: r["taken"] for r in report if r["taken"]} == {i: n * len(re.findall(r"[^\x20\x09-\x0D]+", given[i]["text"])) for i, n in taken.items()}
    last = corpus_pipeline.encoded(spark, mixed, SF).collect()
    assert sorted(r["doc_id"] for r in last) == sorted(r["doc_id"] for r in mixed.collect())
    assert all(r["decoded_sha256"] == hashlib.sha256(given[r["doc_id"]]["text"].encode()).hexdigest() and len(r["ids"]) == r["n_tokens"] for r in last)
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, last))


def test_stages_on_odd_and_empty_documents(spark):
    kind = T.StructType([*table(spark, SF, "documents").schema.fields, T.StructField("score", T.StringType()), T.StructField("vertex", T.IntegerType())])
    rows = [(1, "the and of hello there", "en", "a", 5, "s", 1), (None, None, None, None, None, None, None), (2, "", None, "b", 0, None, None),
            (3, "x " * 30000, "en", None, None, "s", 3), (1, "the and of hello there", "en", "a", 5, "s", 1), (4, "??? !!!", "en", "a", 1, "s", 2)]
    for n in (len(rows), 0):
        docs = spark.createDataFrame(rows[:n], kind)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == [f.name for f in kind]
            docs = stored(docs, "t")
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


@pytest.mark.parametrize("rows", [0, 2])
def test_queries_on_empty_and_null_tables(spark, tmp_path, rows):
    """Every query over tables without rows, and with rows of nothing but nulls."""
    sf = str(tmp_path)
    for name in ("documents", "embeddings", "pages", "labels"):
        given = table(spark, SF, name)
        nulls = given.limit(rows).select(*[F.lit(None).cast(t).alias(c) for c, t in given.dtypes])
        nulls.write.parquet(f"{sf}/{name}.parquet")
    for name, query in queries.QUERIES.items():
        got = query(spark, sf).collect()
        assert len(got) == {"op5_nearest": 0, "op11_filter_audit": 600 * (rows > 0)}.get(name, rows), name
    assert len(corpus_pipeline.run(spark, sf).collect()) == 0
