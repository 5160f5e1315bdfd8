"""Language identification by nearest centroid.

A text is a vector of its letters' 1-, 2- and 3-grams (lower case, every run of other characters
one blank), hashed into DIM counts, times the inverse document frequency, of length 1; counts are
not damped, so that a passage in another language weighs no more than its share.  Each language
has several centroids, found by spherical k-means over a bounded sample of its labelled texts; a
text gets the language of the centroid with the largest cosine.

Rejection.  How near a text comes to its own language depends on its length: a word shares little
with a centroid, a page nearly all.  So the least cosine is a bound by the number of n-grams, learned
per language: the sampled texts are cut to several numbers of words, at a place that the text's hash
chooses, and the bound at a length is ``reject`` times the middle cosine there.  Cuts of a few words
scatter widely, so for them the bound is also no higher than what nearly all of them reach.  A text is
rejected when its cosine is under the bound of its language at its length, or when there is nothing
to compare.

Training: the sample holds about ``per_language`` distinct texts of each language, chosen by a hash of
the text from all of them, so copies neither crowd a language out nor fill its sample; every language
with a text is learned.  Sampled texts become counts where they are read, and only those that are not 0
are stored and shuffled; one task per language runs k-means over its bounded number of them, as one matrix
of ``per_language`` rows without copies of it, and the bounds come from one row per cut.  Scoring is one
pass over whole texts, a bounded piece of a batch at a time.  The model is sent with the tasks: a language
takes ``clusters`` rows of DIM floats, fewer clusters and then fewer dimensions (counts are folded) if
all languages would exceed ``max_bytes`` that way.

Cases: a text that is null or has no letter is ``und`` with score 0 and rejected; rows with a null
language or text are never learned from; if nothing can be learned (an empty table, no labels)
every text is ``und``; equal cosines go to the first language by code point; repeated rows are
scored row by row; other columns are ignored, or kept by ``keep_known``.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .textscan import slices

DIM = 4096
#: Words of the cuts that bounds are learned from; those of up to SHORT words scatter widely.
CUTS, SHORT = (1, 2, 4, 8, 16, 32, 64, 128, 256, 1024), 8
#: Rows whose counts are held at once, and about the characters of a piece.
ROWS, PIECE = 128, 1 << 19
#: A count of a text that is not 0, as it is stored.
COUNT = np.dtype([("at", "<u2"), ("n", "<f4")])


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def counts(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, n-gram counts [rows, DIM] as float32, has a letter [rows]) of each piece."""
    letter, lo = letters(), 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and hi - lo < ROWS and (hi == lo or size + len(texts[hi] or "") <= PIECE):
            size += len(texts[hi] or "")
            hi += 1
        rows = hi - lo
        # one character that is no letter ends each row, so the rows stay apart
        low = [(t or "").lower() for t in texts[lo:hi]]
        lens = np.array([len(t) + 1 for t in low])
        points = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = letter[points]
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1]
        c = np.where(is_letter, points, 32)[keep]
        row = np.repeat(np.arange(rows, dtype=np.int64), lens)[keep] * DIM
        out = np.zeros(rows * DIM)
        with np.errstate(over="ignore"):
            a, b = c * np.uint32(0x9E3779B1), c * np.uint32(0x85EBCA6B)
            d = c * np.uint32(0xC2B2AE35)
            grams = [a, a[:-1] + (b[1:] ^ np.uint32(0x5BD1E995)),
                     a[:-2] + b[1:-1] + (d[2:] ^ np.uint32(0x27D4EB2F))]
            for k, g in enumerate(grams):
                if len(g):
                    g = (g ^ (g >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                    same = row[:len(g)] == row[k:]
                    out += np.bincount((row[:len(g)] + (g >> np.uint32(20)))[same], minlength=len(out))
        found = np.zeros(rows, bool)
        found[np.unique(row // DIM)] = True
        yield lo, out.reshape(rows, DIM).astype(np.float32), found
        lo = hi


def packed(c: np.ndarray) -> pa.Array:
    """The counts of each row that are not 0, as a binary column."""
    row, at = np.nonzero(c)
    out = np.empty(len(at), COUNT)
    out["at"], out["n"] = at, c[row, at]
    bounds = np.searchsorted(row, np.arange(len(c) + 1)).astype(np.int32) * COUNT.itemsize
    return pa.Array.from_buffers(pa.binary(), len(c), [None, pa.py_buffer(bounds), pa.py_buffer(out.tobytes())])


def unpacked(values: list[bytes], dim: int) -> np.ndarray:
    """Counts [rows, dim] as float32."""
    found = np.frombuffer(b"".join(values), COUNT)
    out = np.zeros((len(values), dim), np.float32)
    out[np.repeat(np.arange(len(values)), [len(x) // COUNT.itemsize for x in values]), found["at"]] = found["n"]
    return out


def tfidf(n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of count times idf, of length 1; counts are folded to idf's dimensions."""
    v = n.reshape(len(n), -1, len(idf)).sum(1) * idf
    return v / np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-12)


def kmeans(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means, started at rows far from each other."""
    at = [int(np.argmax(v @ v.mean(0)))]
    near = v @ v[at[0]]
    while len(at) < min(k, len(v)):
        at.append(int(np.argmin(near)))
        near = np.maximum(near, v @ v[at[-1]])
    c = v[at].copy()
    for _ in range(rounds):
        own = np.argmax(v @ c.T, axis=1)
        for j in range(len(c)):
            rows = np.flatnonzero(own == j)
            if len(rows):
                m = v[rows[0]].copy()
                for i in rows[1:]:      # a sum of v[rows] would copy up to the whole sample
                    m += v[i]
                c[j] = m / max(float(np.linalg.norm(m)), 1e-12)
    return c


def centroids(values: list[bytes], idf: np.ndarray, clusters: int) -> np.ndarray:
    """Centroids of the texts whose packed counts are given."""
    v = np.empty((len(values), len(idf)), np.float32)
    for lo in range(0, len(v), ROWS):
        v[lo:lo + ROWS] = tfidf(unpacked(values[lo:lo + ROWS], len(idf)), idf)
    return kmeans(v, clusters)


def sampled(rows: DataFrame, per_language: int) -> tuple[list[str], DataFrame]:
    """The languages, and lang and text of about ``per_language`` distinct texts of each."""
    rows = rows.select("lang", "text", F.xxhash64("text").alias("h"))
    distinct = rows.groupBy("lang", "h").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.count("*").alias("n"))
    shares = stored(distinct.select(F.col("lang").alias("_lang"), F.least(F.lit(1.0), F.lit(per_language) / F.col("n")).alias("share")), "langid-shares")
    names = sorted(r["_lang"] for r in shares.select("_lang").collect())       # a row per language
    chosen = (rows.join(shares, F.col("lang") == F.col("_lang"))
              .where(F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30))
              .groupBy("lang", "h").agg(F.min("text").alias("text")))
    return names, stored(chosen.select("lang", "text"), "langid-sample")


def cut(text: str, n: int) -> str | None:
    """``n`` consecutive words of a text, at a place chosen by its hash (null if it has fewer)."""
    words = text.split()
    if len(words) < n:
        return None
    at = zlib.crc32(text.encode("utf-8", "replace")) % (len(words) - n + 1)
    return " ".join(words[at:at + n])


def learn(rows: DataFrame, per_language: int = 1500, clusters: int = 3, reject: float = 0.55, max_bytes: int = 24 << 20) -> dict:
    """Model from ``rows`` (text, lang): languages, centroids, and each language's least cosine by
    number of n-grams."""
    names, sample = sampled(rows.where("text is not null and lang is not null"), per_language)
    dim = DIM
    clusters = max(1, min(clusters, max_bytes // (4 * dim * max(len(names), 1))))
    while len(names) * clusters * dim * 4 > max_bytes and dim > 64:
        dim //= 2

    def vectors(batches):
        for batch in slices(batches):
            for lo, c, found in counts(batch.column(1).to_pylist()):
                c = c.reshape(len(c), -1, dim).sum(1)[found]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(found)).filter(pa.array(found)), packed(c)], names=["lang", "counts"])

    counted = stored(sample.mapInArrow(vectors, "lang string, counts binary"), "langid-counts")

    def seen(batches):
        df, n = np.zeros(dim, np.int64), 0
        for batch in slices(batches):
            df += np.bincount(np.frombuffer(b"".join(batch.column(1).to_pylist()), COUNT)["at"], minlength=dim)
            n += len(batch)
        yield pa.RecordBatch.from_pydict({"df": [df.tolist()], "n": [n]})

    df, n = np.zeros(dim), 0
    for r in counted.mapInArrow(seen, "df array<long>, n long").collect():      # dim counts a task
        df += r["df"]
        n += r["n"]
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)

    def centre(key, pdf):
        c = centroids(pdf["counts"].tolist(), idf, clusters)
        return pd.DataFrame({"lang": [key[0]] * len(c), "centroid": [x.tolist() for x in c]})

    got = sorted(counted.groupBy("lang").applyInPandas(centre, "lang string, centroid array<float>").collect())
    names = sorted({r["lang"] for r in got})
    model = {"languages": names, "idf": idf, "centroids": np.array([r["centroid"] for r in got], np.float32).reshape(-1, dim),
             "owner": np.array([names.index(r["lang"]) for r in got], np.int64), "bounds": {}}

    def nearness(batches):
        for batch in slices(batches):
            for words in CUTS:
                both = [(lang, c) for lang, t in zip(*(batch.column(k).to_pylist() for k in (0, 1))) if (c := cut(t, words)) is not None]
                lo = 0
                for own, cos, size, found in nearest([c for _, c in both], model):
                    lang = pa.array([x for x, _ in both[lo:lo + len(found)]], pa.string()).filter(pa.array(found))
                    lo += len(found)
                    yield pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(lang), words, np.int32)), pa.array(size[found].astype(float)),
                                                      pa.array(cos[found].astype(float))], names=["lang", "words", "size", "cos"])

    figures = (sample.mapInArrow(nearness, "lang string, words int, size double, cos double").groupBy("lang", "words")
               .agg(F.percentile("size", F.lit(0.5)).alias("size"), F.percentile("cos", F.lit(0.5)).alias("middle"), F.percentile("cos", F.lit(0.01)).alias("low")))
    bounds: dict[int, list] = {}
    for r in sorted(figures.collect()):         # a row per language and number of words
        least = reject * r["middle"]
        bounds.setdefault(names.index(r["lang"]), []).append((r["size"], min(least, r["low"]) if r["words"] <= SHORT else least))
    model["bounds"] = {k: tuple(np.array(x) for x in zip(*sorted(b))) for k, b in bounds.items()}
    return model


def nearest(texts: list[str | None], model: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(language, cosine, number of n-grams, has a letter) of the texts, a piece at a time."""
    for _, c, found in counts(texts):
        if not model["languages"]:
            yield np.zeros(len(c), np.int64), np.zeros(len(c)), np.zeros(len(c)), np.zeros(len(c), bool)
            continue
        cos = tfidf(c, model["idf"]) @ model["centroids"].T
        at = np.argmax(cos, axis=1)
        yield model["owner"][at], cos[np.arange(len(cos)), at].astype(float), c.sum(1), found


def identify(texts: list[str | None], model: dict) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, cosine, and whether it is accepted, of each text."""
    names, score, kept = [], [np.zeros(0)], [np.zeros(0, bool)]
    for own, cos, size, found in nearest(texts, model):
        least = np.zeros(len(own))
        for k in np.unique(own[found]):
            sizes, bounds = model["bounds"][k]
            least[own == k] = np.interp(np.log(np.maximum(size[own == k], 1)), np.log(sizes), bounds)
        names += [model["languages"][o] if f else "und" for o, f in zip(own, found)]
        score.append(np.where(found, np.clip(cos, 0, 1), 0.0))
        kept.append(found & (cos >= least))
    return names, np.concatenate(score), np.concatenate(kept)


def predict(docs: DataFrame, model: dict, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row of ``docs``."""

    def run(batches):
        for batch in slices(batches):
            names, score, kept = identify(batch.column(2).to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score, pa.float64()),
                 pa.array(~kept, pa.bool_())], names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, all columns kept."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in slices(batches):
            _, _, kept = identify(batch.column(at).to_pylist(), model)
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
