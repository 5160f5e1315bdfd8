"""op11 to op13 against plain code: orders run one by one, the tokenizers on whole texts, brute force."""

import hashlib
import itertools
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricelake.llm import align, filteraudit, packing, words
from pricelake.llm.common import ship

WORDS, A, B = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "a", " a", "a ", "a  b", "\t\n", "x \ny", "naïve café — “quoted” …", "ﬁ ſ İ ǅ Σς",
       "é ́x   y  z", "<|endoftext|> and<|startoftext|>", "a▁b", "</s> <s> <unk> <0x41>", "日本語 テスト 。",
       "🦊🦊 \U0001f468‍\U0001f469‍\U0001f467", "tab\tand  many   blanks    ", "it's we'll I'D", "a\x00b \x01", "x" * 5000,
       "word " * 3000, "　a 　 b", "don't stop", "1234567 89"]


def texts(n=60, seed=5):
    rng = random.Random(seed)
    some = ["the", "of", "Überfluß", "señor", "data", "x1", "...", "\n", "\t", "  ", "l'été", "#$%", "ВОДА", "中文", "<|endoftext|>", "--", " "]
    return [" ".join(rng.choice(some) for _ in range(rng.randint(1, 80))) for _ in range(n)]


def frame(spark, rows, schema="doc_id long, text string"):
    ship(spark)
    return spark.createDataFrame(rows, schema)


# ------------------------------------------------------------------------------------ words
def test_ids_of_words_are_those_of_whole_texts():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    own = [*ODD, *texts(), "x'smile l'eau 'S '' ''s .'s 'LL 'l 're're'v' 'Ve'd'T'm 5's 's5 é'é'sé 'sà", "ÀÉÎÕÜß×÷ÿþÞ Ÿ ø×ø", "12a3 4'4", "<| <|endoftext|>A",
           "<|ENDOFTEXT|> <|endoftext|>", "a\x1cb\x7f c\x85d", "naïve\xa0x É́ É", "'", "x'", "'r", "x'r", "x'l'", "'s", "q're'"]
    rng = random.Random(8)
    own += ["".join(rng.choice(list("aZ'sStTrReEvVmMlLdD09.,<| éÉß×çñ\n\t“Ωß") + [" ", "'"]) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    got = {}
    for lo, hi, ids, bounds in packing.encoded(pa.array(own, pa.string()), WORDS, 0):
        got.update({lo + k: ids[a:b].tolist() for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))})
    for k, t in enumerate(own):
        assert got[k] == [*tok.encode(t or "", add_special_tokens=False).ids, 0], t


def test_words_are_forgotten_and_encoded_again(monkeypatch):
    monkeypatch.setattr(words, "KEPT", 5)
    calls = []
    known = words.WordIds(lambda ws: (calls.append(len(ws)) or words.one_by_one([[len(w)] for w in ws]),), 1)
    for text in ["a bb ccc", "dddd eeeee ffffff", "a bb ccc"]:
        data = np.frombuffer(text.encode(), np.uint8)
        starts, first = words.cuts(data, np.array([0, len(data)]))
        ids, _ = words.flat_ids(known.take(known.find(words.as_binary(data, starts)), 0))
        assert ids.tolist() == [len(w) + (k > 0) for k, w in enumerate(text.split(" "))]
    assert calls == [3, 3, 3]


# ------------------------------------------------------------------------------------ op11
def plain_audit(docs, labels):
    marks = {}
    for i, q, t in labels:
        if i is not None:
            g = marks.get(i, (False, False))
            marks[i] = (g[0] or q == 1, g[1] or t == 1)
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    parts = {}
    for i, t, s in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {k for k, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            bool(re.search(r"[#$%&*|]", t)), i is not None and i > first[t])) if bad}
        parts.setdefault(s or "", []).append((fails, *marks.get(i, (False, False))))
    out = {}
    for part, rows in parts.items():
        total = Counter()
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                total[f] += len(gone)
                failing = [r for r in rows if f in r[0]]
                out[part, "".join(order), step] = [len(left), len(gone), len(failing) - len(gone), sum(r[0] == {f} for r in rows),
                                                   sum(r[1] for r in gone), sum(r[2] for r in gone)]
        for (p, order, step), r in out.items():
            if p == part:
                r.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audited(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in rows}
    assert len(out) == len(rows)
    return out


def test_filter_audit(spark):
    rng = random.Random(3)
    some = ["plain", "Words", "UPPER", "a#b", "x|y", "the", "one two three", "Ä", " "]
    docs = []
    for i in range(150):
        t = " ".join(rng.choice(some if i % 3 else [f"w{k}" for k in range(300)]) for _ in range(rng.choice([0, 5, 190, 210, 400])))
        docs.append((rng.choice([i, i, i, None]), rng.choice([t, t, t, None]), rng.choice(["s1", "s2", "", None])))
    docs += rng.choices(docs, k=90)                                         # repeated rows
    docs += [(1000 + k, docs[k % 7][1], "s3") for k in range(60)]           # copies
    docs += [(7, "other text of a known id", "s1"), (7, "x" * 200_000, "s2")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(0, 160, 2), None, None, 4, 4, 1003, 1010]]
    ship(spark)
    d = spark.createDataFrame([(*x, "clash", 1) for x in docs], "doc_id long, text string, source string, part string, n int")
    got = audited(filteraudit.audit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    assert got == plain_audit(docs, labels)
    assert len(got) == 4 * 600


def test_filter_audit_of_other_filters(spark):
    docs = frame(spark, [(1, "aa", "s"), (2, "ab", "s"), (3, "b", "s")], "doc_id long, text string, source string")
    labels = frame(spark, [(2, 1, 0)], "doc_id long, quality int, toxic int")
    got = audited(filteraudit.audit(docs, labels, {"x": lambda t: t.contains("a"), "y": lambda t: t.contains("b")}))
    assert got == {("s", "xy", 1): (1, 2, 0, 1, 1, 0, 3), ("s", "xy", 2): (0, 1, 1, 1, 0, 0, 3),
                   ("s", "yx", 1): (1, 2, 0, 1, 1, 0, 3), ("s", "yx", 2): (0, 1, 1, 1, 0, 0, 3)}


def test_filter_audit_of_nothing(spark):
    docs = frame(spark, [], "doc_id long, text string, source string")
    assert filteraudit.audit(docs, frame(spark, [], "doc_id long, quality int, toxic int")).count() == 0


# ------------------------------------------------------------------------------------ op12
def fewest(sizes, capacity):
    best, sizes = len(sizes), sorted(sizes, reverse=True)

    def extend(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for j in {b: j for j, b in enumerate(bins) if b + sizes[k] <= capacity}.values():
            bins[j] += sizes[k]
            extend(k + 1, bins)
            bins[j] -= sizes[k]
        extend(k + 1, [*bins, sizes[k]])

    extend(0, [])
    return best


def check_packing(out, n, capacity):
    used = np.zeros(capacity + 1, np.int64)
    for times, filling in out:
        assert times > 0 and sum(s * k for s, k in filling) <= capacity
        for s, k in filling:
            used[s] += times * k
    assert (used == n).all()
    return sum(t for t, _ in out)


def test_bin_completion_is_optimal_on_small_inputs():
    rng = random.Random(1)
    for _ in range(150):
        capacity = rng.choice([10, 20, 30, 50])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 10))]
        n = np.bincount(sizes, minlength=capacity + 1)
        assert packing.lower_bound(n, capacity) <= fewest(sizes, capacity) == check_packing(packing.pack_counts(n, capacity), n, capacity)


@pytest.mark.parametrize("sizes, at_most", [
    (np.random.default_rng(3).integers(500, 1100, 100_000), 41_500),        # best-fit: 42,195
    (np.random.default_rng(4).integers(1, 2048, 100_000), None),
    (np.full(100_000, 3), 100_000 // 682 + 1), (np.full(7, 2048), 7), (np.ones(5000, int), 3)])
def test_packing_of_many_pieces(sizes, at_most):
    n = np.bincount(sizes, minlength=2049)
    best = sum(t for t, _ in packing.best_fit(n, 2048))
    got = check_packing(packing.pack_counts(n, 2048), n, 2048)
    assert packing.lower_bound(n, 2048) <= got <= (at_most or best) and got <= best


def test_packing(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    rng = random.Random(2)
    rows = list(enumerate([*ODD, *texts(40), *["same text"] * 30])) + [(None, "no id"), (3, "id again"), (3, "id again")]
    rows += [(500 + k, "long words " * rng.randint(10, 300)) for k in range(25)]
    docs = frame(spark, [(*r, 1) for r in rows], "doc_id long, text string, length int").repartition(5)
    capacity = 64
    got = packing.pack(docs, WORDS, capacity=capacity, with_ids=True).collect()
    want = Counter()
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            own = ids[a:a + capacity]
            want[i, k, a, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own)), tuple(own)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])) for r in got) == want
    filled = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= capacity
    assert len(filled) <= -(-sum(filled.values()) // capacity) + 1
    whole = {r["sequence_id"]: list(r["ids"]) for r in packing.sequences(spark.createDataFrame(got)).collect()}
    assert whole == {s: [x for r in sorted((r for r in got if r["sequence_id"] == s), key=lambda r: r["offset"]) for x in r["ids"]] for s in filled}


def test_packing_of_nothing(spark):
    assert packing.pack(frame(spark, []), WORDS).count() == 0


# ------------------------------------------------------------------------------------ op13
def plain_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    bytes_a, bytes_b = align.bytes_of_a(A), align.bytes_of_b(B)
    found = []
    for i, t in rows:
        xs, ys = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        whole = (" " + t).encode() if t else b""
        if b"".join(bytes_a[x] for x in xs) != whole or b"".join(bytes_b[y] for y in ys) != whole:
            xs, ys = [], []
        ends_a, ends_b = np.cumsum([len(bytes_a[x]) for x in xs]), np.cumsum([len(bytes_b[y]) for y in ys])
        links = [(x, y) for x, e in zip(xs, ends_a) for y in [ys[k] for k in np.flatnonzero(ends_b == e)]]
        groups, pa_, pb = [], 0, 0
        for e in sorted({*ends_a} & {*ends_b}):
            na, nb = int((ends_a <= e).sum()), int((ends_b <= e).sum())
            groups.append(",".join(map(str, xs[pa_:na])) + "|" + ",".join(map(str, ys[pb:nb])))
            pa_, pb = na, nb
        found.append((i, len(xs), len(ys), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if xs else ""))
    count = Counter(x for r in found for x in r[4])
    most = {}
    for (x, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    return Counter((i, n_a, n_b, n_g, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), sha)
                   for i, n_a, n_b, n_g, links, sha in found)


@pytest.mark.parametrize("most", [align.MOST, 40, 0])
def test_alignment(spark, most):
    rows = [*enumerate([*ODD, *texts(40, 9)]), (None, "no id"), (3, "id again"), (3, "id again")]
    docs = frame(spark, [(*r, 1) for r in rows], "doc_id long, text string, pairs int").repartition(3)
    got = align.report(docs, A, B, most).collect()
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r[c] for c in names) for r in got) == plain_alignment(rows)


def test_alignment_of_nothing(spark):
    assert align.report(frame(spark, []), A, B).count() == 0
    row = align.report(frame(spark, [(1, None), (2, "")]), A, B).orderBy("doc_id").collect()
    assert [tuple(r) for r in row] == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_hash_join_links_tokens_that_end_together():
    a, b = pa.array([[0, 1, 1], [], [2]], pa.large_list(pa.int32())), pa.array([[1, 0, 1], [], [0, 0, 0]], pa.large_list(pa.int32()))
    links = align.align(a, b, pa.array([2, 1, 3], pa.int64()), pa.array([1, 2], pa.int64())[:2])
    # A: doc 0 ends 2, 3, 4; doc 2 ends 3.  B: doc 0 ends 2, 3, 5; doc 2 ends 1, 2, 3
    assert [tuple(r.values())[:4] for r in links.select(["doc", "end", "a", "b"]).to_pylist()] == [(0, 2, 0, 1), (0, 3, 1, 0), (2, 3, 2, 0)]
