"""Operators on texts against plain code: BPE, token files, language, quality, language model."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricelake.llm import bloomlm, bpe, langid, quality, queries, textscan, tokencount
from pricelake.llm.common import table
from pricelake.session import scratch_path

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(queries.VOCABULARY)
PATTERN = public_tokenizers.PATTERN
ODD = [None, "", " ", "\n\t", "a", "A a  A", "é 漢字 😀🏽 x", "don't  stop \r\n\r\n ", "x" * 5000, "0 1\x00 2 \x1c3",
       "word " * 3000, "### %% !! ##", "Ünïcode ñandú Straße"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def odd_docs(spark):
    """Odd texts, a repeated row, a null id, nulls everywhere, and columns whose names clash."""
    rows = [(i, t, "en" if i % 2 else "fr", f"s{i % 3}", i, "c") for i, t in enumerate(ODD)]
    rows += [rows[5], (None, "no id here", None, None, None, None), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score long, _row string")


@pytest.fixture(scope="module")
def tok():
    import tiktoken
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=bpe.vocabulary(PATH), special_tokens={})


def test_word_scan_matches_regular_expression():
    column = pa.array(ODD * 3)
    seen = {}
    for lo, hi, data, offsets in textscan.pieces(column, 4000):
        starts, ends, first = textscan.word_bounds(data, offsets)
        h = textscan.word_hashes(data, starts, ends)
        for r in range(lo, hi):
            a, b = first[r - lo], first[r - lo + 1]
            found = [data[s:e].tobytes().decode().translate(LOWER) for s, e in zip(starts[a:b], ends[a:b])]
            assert found == words((ODD * 3)[r])
            for w, x in zip(found, h[a:b]):
                assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_bpe_equals_the_rank_file_library(tok):
    texts = [t or "" for t in ODD] + ["=-" * k for k in range(60)] + ["a" * k for k in range(60)]
    for t, ids in zip(texts, bpe.encode_texts(texts, PATH, PATTERN)):
        assert list(ids) == tok.encode_ordinary(t)
        assert bpe.decode(ids, PATH) == t.encode()
        starts, ends = bpe.char_spans(ids, PATH)
        for i, a, b in zip(ids, starts, ends):
            piece = bpe.decode(np.array([i]), PATH)
            assert piece in t[a:b].encode() and b - a <= len(piece)


def test_bpe_of_distinct_words(tok):
    """Each distinct word is encoded once, and a text's ids are those of the whole text."""
    rng = random.Random(7)
    signs = [*" \t\n\r''\u0085\u00a0\u3000 aZstlmdrev19", "\u00e9", "\u03b1", "\u4e2d", "\u2014", *'!<|."-']
    texts = ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(3000)]
    assert [list(x) for x in bpe.encode_texts(texts, PATH, PATTERN)] == [tok.encode_ordinary(t) for t in texts]
    known = bpe.word_ids(PATH)
    known.clear()
    list(bpe.encode_texts(["to be, or (not) to be. It's 3rd" + " to be," * 999, None], PATH, PATTERN))
    assert sorted(known.rows) == sorted(b"to| be|,| or| (|not|)| to|.| It|'s| 3|rd".split(b"|"))


def test_bpe_with_another_pattern():
    import tiktoken
    other = r"\p{L}+|\P{L}"
    ref = tiktoken.Encoding("o", pat_str=other, mergeable_ranks=bpe.vocabulary(PATH), special_tokens={})
    texts = [t or "" for t in ODD]
    assert [list(x) for x in bpe.encode_texts(texts, PATH, other)] == [ref.encode_ordinary(t) for t in texts]


def test_bpe_digests_of_odd_rows(spark, tok):
    docs = odd_docs(spark)
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(docs, PATH, PATTERN).collect())
    want = []
    for r in docs.collect():
        ids, t = tok.encode_ordinary(r["text"] or ""), (r["text"] or "").encode()
        want.append((str(r["doc_id"]), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t).hexdigest()))
    assert got == sorted(want)
    full = bpe.encode(docs, PATH, PATTERN, spans=True).where("doc_id = 7").collect()[0]
    assert full["ids"] == tok.encode_ordinary(ODD[7]) and full["ids_end"][-1] == len(ODD[7])
    assert bpe.digests(docs.limit(0), PATH, PATTERN).count() == 0


def test_token_files_are_counted_over_block_ends(spark, tok):
    docs = odd_docs(spark)
    folder = scratch_path(spark, "test-tokens")
    tokencount.write(docs, folder, PATH, PATTERN, queries.END_OF_DOCUMENT)
    want = sorted((str(r["doc_id"]), len(tok.encode_ordinary(r["text"] or ""))) for r in docs.collect())
    for size in (2, 6, 1 << 20):
        got = tokencount.with_ids(tokencount.count(spark, folder, queries.END_OF_DOCUMENT, size), tokencount.numbered(docs))
        assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got.collect()) == want
    with pytest.raises(Exception, match="differ"):
        tokencount.with_ids(tokencount.count(spark, folder, queries.END_OF_DOCUMENT), tokencount.numbered(docs.where("doc_id > 3"))).collect()


def test_token_file_without_last_end(spark, tmp_path):
    (tmp_path / "part-00000-x").write_bytes(np.array([7, 7, 9, 1, 9, 9, 3, 4], "<u2").tobytes())
    (tmp_path / "part-00001-x").write_bytes(b"")
    for size in (2, 4, 1024):
        got = tokencount.count(spark, str(tmp_path), 9, size).orderBy("place").collect()
        assert [(r["place"], r["start"], r["n_tokens"], r["ended"]) for r in got] == [(0, 0, 2, True), (1, 3, 1, True), (2, 5, 0, True), (3, 6, 2, False)]


def test_op6_agrees_with_op10(spark):
    a, b = queries.QUERIES["op6_token_counts"](spark, SF), queries.QUERIES["op10_byte_bpe"](spark, SF)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select("doc_id", "n_tokens").collect()))


def test_language_of_held_out_documents(spark):
    got = queries.QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang").toPandas()
    both = got.merge(docs, on="doc_id")
    assert len(both) == len(docs)
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]).all()
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97 and both.score.between(0, 1).all()
    assert both.rejected.mean() < 0.005


FOREIGN = {
    "fi": "Suomi on pohjoismaa, jossa on tuhansia järviä ja laajoja metsiä. Talvella lunta on paljon ja päivät ovat lyhyitä, mutta kesällä "
          "aurinko paistaa melkein koko yön. Ihmiset viettävät lomansa usein mökillä järven rannalla, saunovat ja uivat.",
    "sw": "Watoto huenda shuleni asubuhi na kurudi nyumbani jioni. Mama anapika chakula kitamu jikoni wakati baba anafanya kazi shambani. "
          "Serikali imetangaza mpango mpya wa kusaidia wakulima wadogo kupata mbegu bora na mbolea.",
    "pl": "Wczoraj wieczorem poszliśmy do kina, żeby obejrzeć nowy film, który bardzo nam się podobał. Rząd ogłosił zmiany w ustawie o "
          "podatkach, które wejdą w życie w przyszłym roku. Dzieci bawią się w ogrodzie, a babcia gotuje obiad.",
}


def test_unlearned_languages_and_junk_are_rejected(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("crc32(cast(doc_id as string)) % 4 <> 2")
    model = langid.learn(docs)
    rng = np.random.default_rng(1)
    junk = lambda letters, sizes: " ".join("".join(rng.choice(list(letters), rng.choice(sizes))) for _ in range(40))
    bad = [t * n for t in FOREIGN.values() for n in (1, 30)] + [" ".join(t.split()[:12]) for t in FOREIGN.values()]
    bad += [junk("asdfghjklqwertyuiop", [4, 6, 9]), junk("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", [60]), "Это совсем другой язык и другие буквы"]
    assert not langid.identify(bad, model)[2].any()
    held = [r["text"] for r in table(spark, "/root/testdata/sf0.01", "documents").where("crc32(cast(doc_id as string)) % 4 = 2 and lang is not null").collect()]
    rows = [(n, t, langid.cut(t, n)) for t in held for n in (1, 2, 3, 5, 20, 100)]
    kept = {}
    for n, t, c in rows:
        if c is not None and c.replace(" ", "").replace(".", "").replace(",", "").isalpha():
            kept.setdefault(n, []).append(bool(langid.identify([c], model)[2][0]))
    assert all(np.mean(x) > 0.97 for x in kept.values()), {n: np.mean(x) for n, x in kept.items()}
    assert langid.identify(held, model)[2].mean() > 0.99


def test_all_labelled_languages_are_learned(spark):
    few = [("xx", "kuku paku tiktak zumzum rarara")] * 3000 + [("xx", "paku kuku rarara zumzum")]     # two distinct texts
    rng = np.random.default_rng(3)
    names = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 3)) for _ in range(400)]
    many = [(f"l{k}", " ".join([w * 2, w[::-1], w] * 5)) for k, w in enumerate(names)]
    model = langid.learn(spark.createDataFrame([*few, *many, ("no", "??"), ("no", None), (None, "text")], "lang string, text string"),
                         per_language=50, max_bytes=1 << 20)
    assert model["languages"] == sorted({"xx", *(c for c, _ in many)})
    assert model["centroids"].nbytes <= 1 << 20
    got, _, kept = langid.identify(["kuku paku tiktak", many[7][1], "?"], model)
    assert got[0] == "xx" and got[2] == "und" and list(kept) == [True, True, False]
    assert got[1] == next(c for c, t in sorted(many) if t == many[7][1])


def peak_bytes(run):
    """What ``run`` allocates at most beyond what was there."""
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak


def test_centroids_hold_their_sample_once():
    rng = np.random.default_rng(5)
    idf = rng.random(langid.DIM).astype(np.float32) + 1
    for n in (1, 5, 700):
        c = (rng.poisson(0.15, (n, langid.DIM)) * rng.integers(1, 300, (n, langid.DIM))).astype(np.float32)
        c[:, 0] += 1 << 20
        v = langid.tfidf(c, idf)
        got = langid.kmeans(v, 1, rounds=1)
        total = v.sum(0)
        assert (got == total / float(np.linalg.norm(total))).all()
        if n == 700:    # k-means copied the rows of a cluster, here all of them
            assert peak_bytes(lambda: langid.kmeans(v, 1, rounds=1)) < v.nbytes / 2
        values = langid.packed(c).to_pylist()
        assert all(len(x) == 6 * (row > 0).sum() for x, row in zip(values, c))      # zeros are not stored
        assert (langid.unpacked(values, langid.DIM) == c).all()
        assert (langid.centroids(values, idf, 3) == langid.kmeans(v, 3)).all()
    assert peak_bytes(lambda: langid.centroids(values, idf, 3)) < 2 * v.nbytes


def test_language_of_odd_rows(spark):
    docs = table(spark, SF, "documents")
    model = langid.learn(docs)
    odd = odd_docs(spark)
    got = langid.predict(odd, model, F.lit(False)).collect()
    assert len(got) == odd.count()
    texts = {r["doc_id"]: r["text"] for r in odd.collect() if r["doc_id"] is not None}
    for r in got:
        if r["doc_id"] is not None:
            letters = any(c.isalpha() for c in texts[r["doc_id"]] or "")
            assert (r["lang_pred"] != "und") == letters and (letters or r["rejected"])
    strange = spark.createDataFrame([(1, "это совсем другой язык и другие буквы")], "doc_id long, text string")
    assert langid.predict(strange, model, F.lit(False)).collect()[0]["rejected"]
    assert langid.keep_known(odd, model).columns == odd.columns
    nothing = langid.learn(docs.limit(0))
    assert {r["lang_pred"] for r in langid.predict(odd, nothing, F.lit(False)).collect()} == {"und"}
    assert langid.predict(odd.limit(0), model, F.lit(False)).count() == 0


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op2_quality"](spark, sf).toPandas()
    both = got.merge(table(spark, sf, "labels").toPandas(), on="doc_id")
    held = both[both.held_out]
    assert (held.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in held.doc_id]).all()
    assert (held.predicted == held.quality).mean() > 0.99
    assert (got.predicted == (got.score >= 0.3)).all() and got.score.between(0, 1).all()


def test_quality_of_odd_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.learn(docs, labels, F.lit(True))
    odd = odd_docs(spark)
    got = quality.classify(odd, model, F.lit(False)).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert quality.keep_good(odd, model).columns == odd.columns
    unlearned = quality.learn(docs, labels.limit(0), F.lit(True))
    assert {r["score"] for r in quality.classify(odd, unlearned, F.lit(False)).collect()} == {0.5}
    nulls = spark.createDataFrame([(1, None), (None, 1), (10**9, 1)], "doc_id long, quality int")
    assert quality.learn(docs, nulls, F.lit(True))["base"] == 0.0
    assert quality.classify(odd.limit(0), model, F.lit(False)).count() == 0


def test_figures_of_a_text():
    x = dict(zip(quality.FIGURES, quality.figures(pa.array(["Ab ab ab cd#\nxy xy\nxy xy", None]))[0]))
    assert x["log_words"] == math.log1p(8) and x["distinct_words"] == 3 / 8 and x["top_word"] == 0.5
    assert x["repeated_next"] == 5 / 8 and x["words_with_symbol"] == 1 / 8 and x["distinct_lines"] == 2 / 3
    assert quality.figures(pa.array([None, ""], pa.string())).shape == (2, len(quality.FIGURES))


@pytest.mark.parametrize("most, order", [(1 << 20, 2), (5, 3)])
def test_language_model_base_and_counts(spark, monkeypatch, most, order):
    monkeypatch.setattr(bloomlm, "MOST", most)     # 5: nearly all words take the joined way
    docs = table(spark, SF, "documents").select("doc_id", "text").unionByName(odd_docs(spark).select((F.col("doc_id") + 10**6).alias("doc_id"), "text"))
    rest = F.coalesce(F.expr("crc32(cast(cast(doc_id as string) as binary)) % 7"), F.lit(0))
    model = bloomlm.learn(docs.where(rest != 2), order=order)
    got = bloomlm.score(docs, model, rest == 2).collect()
    rows = docs.collect()
    tokens = lambda t: [*words(t), "\0end"]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for r in rows if not held(r["doc_id"]) for w in tokens(r["text"]))
    n, v = sum(c.values()), len(c)
    assert (model["n"], model["v"]) == (n, v)
    want = sorted((str(r["doc_id"]), held(r["doc_id"]), len(t), sum(w in c for w in t), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6)) for r in rows for t in [tokens(r["text"])])
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    # the score: the same smoothing on exact counts, quantised to the same levels
    quantised = lambda x: float(bloomlm.middle(bloomlm.level(np.array([x])))[0])
    grams = Counter()
    for r in rows:
        if not held(r["doc_id"]):
            t = ["\0end"] * (order - 1) + tokens(r["text"])
            grams.update(tuple(t[k:k + m]) for m in range(2, order + 1) for k in range(order - m, len(t) - m + 1))
    grams.update({(w,): x for w, x in c.items()})
    known = {g: quantised(x) for g, x in grams.items()}

    def plain(text, mu=1000.0):
        total, out, last = n + v + 1, 0.0, [known.get(("\0end",), 0.0)] * order
        t = ["\0end"] * (order - 1) + tokens(text)
        for k in range(order - 1, len(t)):
            now = [known.get(tuple(t[k - m + 1:k + 1]), 0.0) for m in range(1, order + 1)]
            p = (now[0] + 1) / total
            for m in range(1, order):
                p = min((min(now[m], last[m - 1]) + mu * p) / (last[m - 1] + mu), 1.0)
            out += math.log10(p)
            last = now
        return out

    texts_of = Counter((str(r["doc_id"]), r["text"]) for r in rows)
    mine = {i: plain(t) for i, t in texts_of}
    gaps = [abs(r["score"] - mine[str(r["doc_id"])]) / r["n_tokens"] for r in got
            if sum(k == str(r["doc_id"]) for k, _ in texts_of) == 1]
    # false alarms of the filter (about 1% of absent n-grams) raise a count; one weighs much in a text of two tokens
    assert len(gaps) > 150 and np.mean(gaps) < 0.02 * (order - 1) and np.median(gaps) < 0.02 * (order - 1) and max(gaps) < 3
    # the filter: never too low, seldom too high
    data, offsets = textscan.text_buffers(pa.array([" ".join(sorted(c - Counter(["\0end"])))]))
    names = sorted(w for w in c if w != "\0end")
    h = textscan.word_hashes(data, *textscan.word_bounds(data, offsets)[:2])
    least = bloomlm.middle(bloomlm.level(np.array([c[w] for w in names])))
    found = model["filter"].counts(h[:len(names)])
    if len(h) == len(names):
        assert (found >= least).all() and (found > least).mean() < 0.05


def test_language_model_of_nothing(spark):
    docs = odd_docs(spark)
    got = bloomlm.score(docs, bloomlm.learn(docs.limit(0)), F.lit(True)).collect()
    assert len(got) == docs.count() and all(r["n_known"] == 0 and r["base_score"] == 0 for r in got)
    assert bloomlm.score(docs.limit(0), bloomlm.learn(docs), F.lit(True)).count() == 0


@pytest.mark.parametrize("order", [2, 3])
def test_language_model_larger_than_its_broadcast(spark, monkeypatch, order):
    docs = table(spark, SF, "documents").select("doc_id", "text").unionByName(odd_docs(spark).select("doc_id", "text"))
    train = docs.where("doc_id % 3 > 0")
    want = bloomlm.score(docs, bloomlm.learn(train, order=order), F.lit(True)).collect()
    model = bloomlm.learn(train, order=order, max_bytes=1000)
    assert model["filter"] is None
    monkeypatch.setattr(bloomlm, "FLUSH", 5000)     # several blocks
    got = bloomlm.score(docs, model, F.lit(True)).collect()
    plain = lambda rows: sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in rows)
    assert plain(got) == plain(want)


def test_false_alarms_of_the_filter():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 2**64, 200_000, dtype=np.uint64)
    words = bloomlm.filter_part(h[:100_000], np.ones(100_000, np.int64))
    table = bloomlm.Filter(np.array([len(words)]), 64)
    table.put(0, words.tobytes())
    assert (table.levels(h[:100_000]) > 0).all() and (table.levels(h[100_000:]) > 0).mean() < 0.02


def test_queries_on_null_ids(spark, tmp_path):
    """Rows with a null doc_id are scored, and never held out."""
    sf = str(tmp_path)
    odd_docs(spark).select("doc_id", "text", "lang", "source").write.parquet(f"{sf}/documents.parquet")
    table(spark, SF, "labels").write.parquet(f"{sf}/labels.parquet")
    for name in ("op2_quality", "op4_language_id", "op7_bloom_lm"):
        got = queries.QUERIES[name](spark, sf).collect()
        assert len(got) == odd_docs(spark).count()
        assert [r["held_out"] for r in got if r["doc_id"] is None] == [False, False]
    assert len(queries.QUERIES["op3_mix"](spark, sf).collect()) == len(got)
