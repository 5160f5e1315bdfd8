"""Language-model scoring with a log-frequency Bloom filter.

Counts c of all n-grams (n = 1 .. order) of the training texts are quantised to q = 1 + floor(log2 c)
and every n-gram is put into a Bloom filter q times, once with each level 1 .. q.  Asking for the
levels in turn until one is missing gives q back (a false alarm, about 1 in 100, can only raise
it), and the count is taken as the middle of its range.  With these counts

    p(w) = (c(w) + 1) / (N + V + 1),    p(w | h) = (c(hw) + mu * p(w | h')) / (c(h) + mu),

h' being h without its first word; the score of a text is the sum of log10 p over its tokens.  A
document is its words (A-Z lower-cased) and one end token; the context of a first word is the end
token.  Words are 64-bit hashes.

Building: tasks combine the n-grams of up to FLUSH tokens into sorted distinct hashes with counts
and cut them into hash slices; a slice's arrays meet in one task, which adds up its exact counts
and makes the slice's part of the filter.  The number of slices follows the number of documents,
so a slice stays small, and a frequent word is one entry of each combined array.  The filter always
gets BITS bits per entry.

Scoring: a filter of up to ``max_bytes`` in all is broadcast.  A larger one stays in its slices: rows
are gathered in blocks of about FLUSH tokens, a block's distinct n-grams go to their slices (each
once, so no frequent n-gram is a hot key), and the levels found come back to the block, which meets
its texts again by its number.  The filter sees the upper 48 bits of a hash, so only these are sent.

The add-one base score needs exact counts of single words.  The words with the largest counts, at
most MOST of them (12 bytes each), are broadcast; the others are joined by word hash, so the
vocabulary may grow without bound and no frequent word is a join key.

Cases: a null text is empty: one end token; texts are taken whole; rows that agree in id and text
get equal figures; null ids are allowed; without training texts N and V are 0 and every
probability is 1; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .textscan import BASE, U, mix, pieces, word_bounds, word_hashes

END = U(0x5851F42D4C957F2D)
FLUSH = 1 << 20
BITS, HITS = 12, 4
#: Lower bits of a hash that the filter does not see.
UNSEEN = 16
MOST = 1 << 19


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows, and the index of each row's first one."""
    starts, ends, first = word_bounds(data, offsets)
    rows = len(offsets) - 1
    out = np.full(len(starts) + rows, END, U)
    out[np.arange(len(starts)) + np.repeat(np.arange(rows), np.diff(first))] = word_hashes(data, starts, ends)
    return out, first + np.arange(rows + 1)


def start_state(k: int) -> np.uint64:
    """Hash of k end tokens: the context of a first word."""
    h = np.array([END])
    for n in range(2, k + 1):
        h = mix(h * U(BASE) + END + U(n))
    return h[0]


def ngrams(t: np.ndarray, first: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 .. order: (context hash, n-gram hash) at every token; there is no context for 1."""
    out = [(t[:0], t)]
    begin = first[:-1]
    for n in range(2, order + 1):
        context = np.empty_like(t)
        context[1:] = out[-1][1][:-1]
        context[begin] = start_state(n - 1)
        out.append((context, mix(context * U(BASE) + t + U(n))))
    return out


def level(count: np.ndarray) -> np.ndarray:
    """1 + floor(log2 count)."""
    return np.frexp(count.astype(np.float64))[1].astype(np.int64)


def middle(q: np.ndarray) -> np.ndarray:
    """Count that stands for a level: the middle of 2^(q-1) .. 2^q - 1; 0 for 0."""
    return np.where(q > 0, (1.5 * 2.0 ** (q - 1)) - 0.5, 0.0)


def _place(h: np.ndarray, q: int, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word within the slice, and bits within the word, of n-grams at a level."""
    g = mix((h >> U(UNSEEN)) + U(q * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF))
    at = ((g >> U(32)) * words >> U(32)).astype(np.int64)
    bits = np.zeros(len(g), U)
    for k in range(HITS):
        bits |= U(1) << ((g >> U(6 * k)) & U(63))
    return at, bits


def filter_part(h: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Filter words of one slice, from its n-grams and their levels."""
    words = int(q.sum()) * BITS // 64 + 1
    out = np.zeros(words, U)
    for j in range(1, int(q.max(initial=0)) + 1):
        at, bits = _place(h[q >= j], j, U(words))
        order = np.argsort(at, kind="stable")
        at, bits = at[order], bits[order]
        new = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else at
        if len(at):
            out[at[new]] |= np.bitwise_or.reduceat(bits, new)
    return out


class Filter:
    """All slices' parts, as one array with the place and size of each."""

    def __init__(self, sizes: np.ndarray, shift: int):
        self.size = sizes.astype(U)
        self.start = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.words = np.zeros(int(sizes.sum()), U)
        self.shift = shift

    def put(self, part: int, words: bytes) -> None:
        at = self.start[part]
        self.words[at:at + len(words) // 8] = np.frombuffer(words, U)

    def levels(self, h: np.ndarray) -> np.ndarray:
        """Levels, which are asked for until one is missing."""
        q, todo = np.zeros(len(h), np.int64), np.arange(len(h))
        part = (h >> U(self.shift)).astype(np.int64) if self.shift < 64 else np.zeros(len(h), np.int64)
        start, size, j = self.start[part], self.size[part], 1
        while len(todo) and j < 64:
            at, bits = _place(h[todo], j, size[todo])
            todo = todo[(self.words[start[todo] + at] & bits) == bits]
            q[todo] = j
            j += 1
        return q

    def counts(self, h: np.ndarray) -> np.ndarray:
        """Estimated counts."""
        return middle(self.levels(h))


def _planes(h: np.ndarray) -> bytes:
    """Bytes of ascending numbers by significance, which the shuffle's compression makes smaller."""
    return h.view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view(U).reshape(-1)


def _seen(h: np.ndarray) -> bytes:
    """The planes that the filter sees."""
    return _planes(h)[len(h) * UNSEEN // 8:]


def _seen_numbers(b: bytes) -> np.ndarray:
    return _numbers(bytes(len(b) // (8 - UNSEEN // 8) * UNSEEN // 8) + b)


class Answers:
    """Levels that the slices found for one block's n-grams: what ``Filter`` is to a whole table."""

    def __init__(self, parts: list[tuple[bytes, bytes]]):
        h = np.concatenate([_seen_numbers(a) for a, _ in parts])
        order = np.argsort(h)
        self.h, self.q = h[order], np.frombuffer(b"".join(b for _, b in parts), np.uint8)[order]

    def counts(self, h: np.ndarray) -> np.ndarray:
        return middle(self.q[np.searchsorted(self.h, h >> U(UNSEEN) << U(UNSEEN))].astype(np.int64))


def _runs(keys: np.ndarray):
    """First and last (exclusive) row of each run of equal rows [rows, keys]."""
    cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
    return zip([0, *cuts], [*cuts, len(keys)]) if len(keys) else ()


def _slices(h: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Slices present in ascending hashes, and the bounds of each."""
    part = (h >> U(shift)).astype(np.int64) if shift < 64 else np.zeros(len(h), np.int64)
    at = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(h) else np.zeros(0, np.int64)
    return part[at], np.append(at, len(h))


def _combined(train: DataFrame, order: int, shift: int) -> DataFrame:
    """slice, kind (1: single words, 2: longer), hashes, counts of up to FLUSH tokens each."""

    def rows(kind, arrays):
        h, c = np.unique(np.concatenate(arrays), return_counts=True)
        part, bounds = _slices(h, shift)
        c = c.astype(np.uint32)
        return pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(np.full(len(part), kind, np.int32)),
             pa.array([_planes(h[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
             pa.array([c[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())],
            names=["slice", "kind", "hashes", "counts"])

    def run(batches):
        held = {1: [], 2: []}
        size = 0
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(0)):
                t, first = tokens(data, offsets)
                grams = ngrams(t, first, order)
                held[1].append(t)
                held[2] += [g for _, g in grams[1:]]
                held[2] += [np.full(hi - lo, start_state(k), U) for k in range(2, order)]
                size += len(t)
                if size >= FLUSH:
                    yield from (rows(k, a) for k, a in held.items() if a)
                    held, size = {1: [], 2: []}, 0
        yield from (rows(k, a) for k, a in held.items() if a)

    return train.select("text").mapInArrow(run, "slice int, kind int, hashes binary, counts binary")


def _added(parts: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, ascending, and their summed counts."""
    if not parts:
        return np.zeros(0, U), np.zeros(0, np.int64)
    h = np.concatenate([_numbers(a) for a, _ in parts])
    c = np.concatenate([np.frombuffer(b, np.uint32) for _, b in parts]).astype(np.int64)
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    at = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    return h[at], np.add.reduceat(c, at)


def learn(train: DataFrame, order: int = 2, max_bytes: int = 96 << 20) -> dict:
    """Model of the texts of ``train``: its filter (to broadcast; null when larger than ``max_bytes``)
    and the table of its slices, frequent words (arrays to broadcast), N and V, and the table of all
    words' exact counts."""
    n = train.count()
    bits = min(20, max(10, (n // 2048).bit_length()))
    slices, shift = 1 << bits, 64 - bits
    spark = train.sparkSession
    met = (_combined(train, order, shift).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "slice")
           .sortWithinPartitions("slice", "kind"))

    def finish(part, one, two):
        h1, c1 = _added(one)
        h2, c2 = _added(two)
        words = filter_part(np.concatenate([h1, h2]), level(np.concatenate([c1, c2])))
        sizes = np.bincount(level(c1), minlength=64)
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([words.tobytes()], pa.binary()), pa.array([h1.tobytes()], pa.binary()),
             pa.array([c1.tobytes()], pa.binary()), pa.array([int(c1.sum())]), pa.array([len(h1)]),
             pa.array([sizes.tolist()], pa.list_(pa.int64()))],
            names=["slice", "filter", "words", "counts", "n", "v", "levels"])

    def add(batches):
        part, held = None, {1: [], 2: []}
        for batch in batches:
            for s, kind, h, c in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if s != part:
                    if part is not None:
                        yield finish(part, held[1], held[2])
                    part, held = s, {1: [], 2: []}
                held[kind].append((h, c))
        if part is not None:
            yield finish(part, held[1], held[2])

    made = stored(met.mapInArrow(
        add, "slice int, filter binary, words binary, counts binary, n long, v long, levels array<long>"), "lm-slices")
    total = made.agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.sum(F.octet_length("filter")).alias("bytes"),
                     *(F.sum(F.col("levels")[k]).alias(f"l{k}") for k in range(64))).collect()[0]
    table = None
    if (total["bytes"] or 0) <= max_bytes:
        sizes = np.ones(slices, np.int64)       # a slice without n-grams is one empty word
        for r in made.select("slice", (F.octet_length("filter") / 8).cast("long").alias("size")).collect():
            sizes[r["slice"]] = r["size"]
        table = Filter(sizes, shift)
        for r in made.select("slice", "filter").toLocalIterator():      # max_bytes at most in all
            table.put(r["slice"], r["filter"])
    per_level = np.array([total[f"l{k}"] or 0 for k in range(64)])
    # the least level from which on there are at most MOST words
    least = next(k for k in range(65) if per_level[k:].sum() <= MOST)

    def split(frequent):
        def run(batches):
            for batch in batches:
                for h, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    h, c = np.frombuffer(h, np.int64), np.frombuffer(c, np.int64)
                    pick = (level(c) >= least) == frequent
                    h, c = h[pick], c[pick]
                    cols = [pa.array([x.tobytes()], pa.binary()) for x in (h, c)] if frequent else [pa.array(h), pa.array(c)]
                    yield pa.RecordBatch.from_arrays(cols, names=["word", "count"])
        kind = "binary" if frequent else "long"
        return made.select("words", "counts").mapInArrow(run, f"word {kind}, count {kind}")

    h, c = np.zeros(int(per_level[least:].sum()), U), np.zeros(int(per_level[least:].sum()), np.int64)
    at = 0
    for r in split(True).toLocalIterator():                         # at most MOST words in all
        n = len(r["word"]) // 8
        h[at:at + n], c[at:at + n] = np.frombuffer(r["word"], U), np.frombuffer(r["count"], np.int64)
        at += n
    by = np.argsort(h)
    return {"filter": table, "parts": made.select("slice", "filter"), "shift": shift, "order": order, "frequent": (h[by], c[by]), "rare": split(False),
            "n": int(total["n"] or 0), "v": int(total["v"] or 0)}


def exact(t: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Counts of frequent words, -1 for others."""
    h, c = frequent
    if not len(h):
        return np.full(len(t), -1)
    at = np.minimum(np.searchsorted(h, t), len(h) - 1)
    return np.where(h[at] == t, c[at], -1)


def log_probability(t: np.ndarray, first: np.ndarray, kinds: np.ndarray, inverse: np.ndarray, model: dict, mu: float) -> np.ndarray:
    """log10 p of every token, given its context; kinds[inverse] is t."""
    total = model["n"] + model["v"] + 1
    c = model["filter"].counts(kinds)[inverse]
    p = (c + 1) / total
    if model["n"] == 0:
        return np.zeros(len(t))
    end = model["filter"].counts(np.array([END]))[0]
    for context, gram in ngrams(t, first, model["order"])[1:]:
        before = np.empty_like(c)       # count of the context: the n-gram one token earlier
        before[1:] = c[:-1]
        before[first[:-1]] = end
        c = model["filter"].counts(gram)
        p = np.minimum((np.minimum(c, before) + mu * p) / (before + mu), 1.0)
    return np.log10(p)


def _sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, first[:-1]) if len(first) > 1 else x[:0]


def _answered(scanned: DataFrame, model: dict, sent, mu: float) -> DataFrame:
    """``scanned`` with the scores, from the slices of a filter that is not broadcast."""
    order, shift = model["order"], model["shift"]
    parts = int(scanned.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def ask(batches):
        def rows():
            h = np.unique(np.concatenate(held) >> U(UNSEEN)) << U(UNSEEN)
            part, bounds = _slices(h, shift)
            return pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(np.full(len(part), block)),
                 pa.array([_seen(h[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())],
                names=["slice", "block", "hashes"])

        block, held = None, []
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            for a, z in _runs(blocks[:, None]):
                if held and blocks[a] != block:
                    yield rows()
                    held = []
                block = blocks[a]
                for _, _, data, offsets in pieces(batch.column(1).slice(a, z - a)):
                    held += [g for _, g in ngrams(*tokens(data, offsets), order)]
        if held:
            yield rows()

    def answer(batches):
        part, table = None, None
        for batch in batches:
            keys = np.column_stack([batch.column(k).to_numpy().astype(np.int64) for k in (0, 1)])
            for a, z in _runs(keys):
                if keys[a, 0] != part:
                    part, table = keys[a, 0], Filter(np.ones(1, np.int64), 64)
                own = batch.slice(a, z - a)
                sent_ = own.column(3).to_pylist()
                if keys[a, 1] == 0:             # the slice's filter comes first
                    table = Filter(np.array([len(sent_[0]) // 8]), 64)
                    table.put(0, sent_[0])
                    continue
                asked = [_seen_numbers(b) for b in sent_]
                q = table.levels(np.concatenate(asked)).astype(np.uint8)
                cut = np.cumsum([0, *map(len, asked)])
                yield pa.RecordBatch.from_arrays(
                    [own.column(2), own.column(3), pa.array([q[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])], pa.binary())],
                    names=["block", "hashes", "levels"])

    names = [c for c in scanned.columns if c not in ("score", "rest", "block", "text")]

    def weigh(batches):
        m, block, held, known = sent.value, None, [], None
        for batch in batches:
            keys = np.column_stack([batch.column(k).to_numpy().astype(np.int64) for k in (0, 1)])
            for a, z in _runs(keys):
                if keys[a, 0] != block:
                    block, held, known = keys[a, 0], [], None
                own = batch.slice(a, z - a)
                if keys[a, 1] == 0:             # the block's answers come first
                    held += zip(own.column(2).to_pylist(), own.column(3).to_pylist())
                    continue
                if known is None:
                    known, held = {**m, "filter": Answers(held)}, []
                p = []
                for _, _, data, offsets in pieces(own.column(4)):
                    t, first = tokens(data, offsets)
                    p.append(_sums(log_probability(t, first, *np.unique(t, return_inverse=True), known, mu), first))
                yield pa.RecordBatch.from_arrays([*own.columns[5:], pa.array(np.concatenate(p))], names=[*names, "score"])

    nothing = F.lit(None).cast("binary")
    asked = scanned.select("block", "text").mapInArrow(ask, "slice int, block long, hashes binary")
    met = (model["parts"].select("slice", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("block"), F.col("filter").alias("hashes"))
           .unionAll(asked.select("slice", F.lit(1), "block", "hashes"))
           .repartition(parts, "slice").sortWithinPartitions("slice", "kind"))
    levels = met.mapInArrow(answer, "block long, hashes binary, levels binary")
    own = [F.lit(None).cast(scanned.schema[c].dataType).alias(c) for c in names]
    back = (levels.select("block", F.lit(0).alias("kind"), "hashes", "levels", F.lit(None).cast("string").alias("text"), *own)
            .unionAll(scanned.select("block", F.lit(1), nothing, nothing, "text", *names))
            .repartition(parts, "block").sortWithinPartitions("block", "kind"))
    kinds = ", ".join(f"{c} {scanned.schema[c].dataType.simpleString()}" for c in names)
    return back.mapInArrow(weigh, f"{kinds}, score double")


def score(docs: DataFrame, model: dict, held_out: Column, mu: float = 1000.0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    n, total = model["n"], model["n"] + model["v"] + 1
    far = model["filter"] is None
    sent = docs.sparkSession.sparkContext.broadcast({k: model[k] for k in ("filter", "order", "frequent", "n", "v")})
    docs = docs.select("doc_id", held_out.alias("held_out"), "text",
                       F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias("key"))
    doc_columns = [("key", pa.int64()), ("text_key", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()),
                   ("base", pa.float64()), ("score", pa.float64())]

    def run(batches):
        m, block, held = sent.value, 0, FLUSH
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(2)):
                t, first = tokens(data, offsets)
                row = np.repeat(np.arange(hi - lo), np.diff(first))
                kinds, inverse = np.unique(t, return_inverse=True)
                c = exact(kinds, m["frequent"])[inverse]
                seen = c >= 0
                place = (np.arange(len(t)) - first[row]).astype(U)
                text_key = _sums(mix(t + place * U(BASE)), first).view(np.int64)
                base = _sums(np.where(seen, np.log10(np.maximum(c, 0) + 1.0), 0.0), first)
                p = np.zeros(hi - lo) if far else _sums(log_probability(t, first, kinds, inverse, m, mu), first)
                # words to look up: distinct ones of each row with their number
                order = np.lexsort((t[~seen], row[~seen]))
                w, r = t[~seen][order], row[~seen][order]
                at = np.flatnonzero(np.append(True, (w[1:] != w[:-1]) | (r[1:] != r[:-1]))) if len(w) else np.zeros(0, np.int64)
                times = np.diff(np.append(at, len(w)))
                bounds = np.searchsorted(r[at], np.arange(hi - lo + 1)).astype(np.int32)
                pairs = pa.StructArray.from_arrays([pa.array(w[at].view(np.int64)), pa.array(times)], ["word", "times"])
                if held + len(t) > FLUSH:
                    block, held = int.from_bytes(os.urandom(8)) >> 1, 0
                held += len(t)
                more = [pa.array(np.full(hi - lo, block)), batch.column(2).slice(lo, hi - lo)] if far else []
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), batch.column(3).slice(lo, hi - lo),
                     pa.array(text_key), pa.array(np.diff(first)), pa.array(_sums(seen.astype(np.int64) * (c > 0), first)),
                     pa.array(base), pa.array(p), pa.ListArray.from_arrays(pa.array(bounds), pairs), *more],
                    names=["doc_id", "held_out", *(k for k, _ in doc_columns), "rest", *(["block", "text"] if far else [])])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    scanned = stored(docs.mapInArrow(
        run, f"doc_id {id_type}, held_out boolean, key long, text_key long, n_tokens long, known long, base double, "
             "score double, rest array<struct<word:long,times:long>>" + (", block long, text string" if far else "")), "lm-scanned")
    asked = scanned.where(F.size("rest") > 0).select("key", "text_key", F.explode("rest").alias("r")).select("key", "text_key", "r.*")
    # rows that agree in id and text ask alike, so each gets the mean of what they asked for
    one = scanned.where(F.size("rest") > 0).groupBy("key", "text_key").agg(F.count("*").alias("rows"))
    rare = model["rare"].withColumnRenamed("word", "_word")
    found = (asked.join(rare, F.col("word") == F.col("_word")).groupBy("key", "text_key")
             .agg(F.sum(F.col("times") * F.log10(F.col("count") + 1.0)).alias("more"), F.sum("times").alias("more_known"))
             .join(one, ["key", "text_key"])
             .select("key", "text_key", (F.col("more") / F.col("rows")).alias("more"),
                     (F.col("more_known") / F.col("rows")).cast("long").alias("more_known")))
    scored = _answered(scanned, model, sent, mu) if far else scanned.drop("rest")
    return (scored.join(found, ["key", "text_key"], "left")
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
                    F.lit(n).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(total))).alias("base_score"),
                    "score"))
