"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide counts of token pairs.

A is a byte-level BPE read by the tokenizers library, B a sentencepiece model.  Both encode a text
with one blank before it, and both cut its bytes into tokens; where a token of A and one of B end
at the same byte, they are linked, and these places cut the text into groups.

A task takes its texts a bounded part at a time, as Arrow columns.  Tokens are flattened with the
index of their parent document; running sums of their lengths, less what came before the document,
are the bytes where they end; a hash join on (document, end) gives the links.  Pairs of ids are
counted by document and by task with ``Table.group_by``; Spark adds up the tasks' counts.

A second pass looks up each document's pairs.  The most frequent ones, MOST at most, are broadcast
with their counts; the others are sent out and joined, each of which occurs less often than any of
the broadcast ones.  So what is broadcast is bounded and nothing is dropped.

Cases: a text that is null or empty, or whose tokens of A or of B do not join to a blank and the text
(one with U+2581, say), has no tokens, and all its numbers are 0 and its digest is the empty string; strings of
special tokens are plain text; texts are taken whole; repeated rows are documents of their own; a
null doc_id is carried on; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_alphabet
from .common import stored
from .textscan import pieces as parts_of
from .textscan import slices
from .words import WordIds, as_binary, by_bytes, cuts, flat_ids, one_by_one, safe_end

#: Bytes of text aligned at once, pairs counted before they are passed on, pairs in a row.
PIECE, FLUSH, ROW = 1 << 20, 1 << 19, 1 << 15
#: Pairs that are broadcast with their counts (17 bytes each).
MOST = 1 << 19
#: A pair as one number: id of A times this, plus id of B.
SHIFT = 1 << 20


def bytes_of_a(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level tokenizer file; of an added token, its text."""
    with open(path, encoding="utf-8") as f:
        tok = json.load(f)
    back = {c: b for b, c in enumerate(byte_alphabet())}
    added = {t["id"]: t["content"].encode() for t in tok.get("added_tokens", [])}
    vocab = {i: t for t, i in tok["model"]["vocab"].items()}
    return [added[i] if i in added else bytes(back[c] for c in vocab[i]) if i in vocab else b""
            for i in range(max([*vocab, *added]) + 1)]


def bytes_of_b(path: str) -> list[bytes]:
    """Bytes of each id of a sentencepiece model: U+2581 is a blank, <0xHH> a byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("\u2581", " ").encode() for p in names]


class Pair:
    """The two tokenizers: ids of words, and whether both give back a word's bytes."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        a.encode_special_tokens = True
        self.bytes_a, self.bytes_b = bytes_of_a(path_a), bytes_of_b(path_b)
        self.sizes = [pa.array([len(x) for x in t], pa.int64()) for t in (self.bytes_a, self.bytes_b)]
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.most, self.written = most, pa.array([s + str(i).encode() for s in (b",", b";", b"|") for i in range(most)], pa.large_binary())

        def of_a(text):
            return a.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)[0].ids

        def of_b(text):         # B adds the first blank by itself
            return b.encode([text[1:].decode("utf-8", "replace")], num_threads=1)[0]

        def back(ids, table):
            return b"".join(map(table.__getitem__, ids.tolist()))

        size_a, size_b = (x.to_numpy() for x in self.sizes)

        def encode(words):
            parts = []
            data = np.frombuffer(b"".join(words), np.uint8)
            joins = safe_end(data, np.cumsum([len(w) for w in words]))
            order = np.argsort(~joins, kind="stable")          # those that another may follow come first
            n = int(joins.sum())
            for lo in [*range(0, n, 512), *range(n, len(words))]:
                own = [words[k] for k in order[lo:min(lo + 512, n) if lo < n else lo + 1]]
                x, y = by_bytes(own, of_a, size_a), by_bytes(own, of_b, size_b)
                text = b"".join(own)
                if x and y and back(x[0], self.bytes_a) == text == back(y[0], self.bytes_b):
                    parts.append((x, y, (np.ones(len(own), np.int32), np.ones(len(own), np.int64))))
                    continue
                for w in own:
                    x, y = (one_by_one([f(w)]) for f in (of_a, of_b))
                    fine = back(x[0], self.bytes_a) == w == back(y[0], self.bytes_b)
                    parts.append((x, y, (np.array([fine], np.int32), np.ones(1, np.int64))))
            out = []
            for k in range(3):
                flat, sizes = (np.concatenate([p[k][j] for p in parts]) for j in (0, 1))
                lists = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes))), pa.array(flat))
                lists = pc.take(lists, pa.array(np.argsort(order)))
                out.append((flat_ids(lists)[0], np.diff(lists.offsets.to_numpy())))
            return tuple(out)

        self.words = WordIds(encode, 3)


@lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def ends(tokens: pa.LargeListArray, sizes: pa.Array) -> pa.Table:
    """doc, end, id and at (the token's place in the column) of every token."""
    ids, doc = pc.list_flatten(tokens), pc.list_parent_indices(tokens)
    through = pc.cumulative_sum(pc.take(sizes, ids)) if len(ids) else pa.array([], pa.int64())
    bounds = tokens.offsets.to_numpy()
    before = np.append(0, through.to_numpy())[bounds[:-1] - bounds[0]]
    return pa.table({"doc": doc.cast(pa.int64()), "end": pc.subtract(through, pc.take(pa.array(before), doc)),
                     "id": ids.cast(pa.int64()), "at": pa.array(np.arange(len(ids)))})


def align(tokens_a: pa.LargeListArray, tokens_b: pa.LargeListArray, sizes_a: pa.Array, sizes_b: pa.Array) -> pa.Table:
    """doc, end, a, b (ids), at_a, at_b (places) of every link, in the order of A's tokens."""
    left = ends(tokens_a, sizes_a).rename_columns(["doc", "end", "a", "at_a"])
    right = ends(tokens_b, sizes_b).rename_columns(["doc", "end", "b", "at_b"])
    return left.join(right, ["doc", "end"], join_type="inner", use_threads=False).sort_by([("at_a", "ascending"), ("at_b", "ascending")])


def written_groups(tokens_a, tokens_b, at_a: np.ndarray, at_b: np.ndarray, pair: Pair) -> tuple[memoryview, np.ndarray]:
    """The groups of all documents as one run of bytes ``;a1,a2|b1;a3|b2,b3``, and where each
    document's begin in it.  ``at_a``, ``at_b``: the last tokens of the groups."""
    (ids_a, cut_a), (ids_b, cut_b) = flat_ids(tokens_a), flat_ids(tokens_b)
    n_a, n_b = len(ids_a), len(ids_b)
    group_a, group_b = np.searchsorted(at_a, np.arange(n_a)), np.searchsorted(at_b, np.arange(n_b))
    order = np.empty(n_a + n_b, np.int64)
    mark_a, mark_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)      # 0 ",", 1 ";", 2 "|"
    mark_a[np.append(0, at_a[:-1] + 1)[:len(at_a)]] = 1
    mark_b[np.append(0, at_b[:-1] + 1)[:len(at_b)]] = 2
    order[np.arange(n_a) + np.append(0, at_b + 1)[group_a]] = ids_a + mark_a * pair.most
    order[np.arange(n_b) + (at_a + 1)[group_b]] = ids_b + mark_b * pair.most
    text = pc.take(pair.written, pa.array(order))
    bounds = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
    data = memoryview(text.buffers()[2]) if len(text) else memoryview(b"")
    return data, bounds[cut_a + cut_b]


def _scan(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per document (part: false) with its figures, its pairs and how often each is linked; and
    rows of pairs with a task's counts (part: true)."""
    names = ["part", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

    def counted(tables: list[pa.Table], kind) -> Iterator[pa.RecordBatch]:
        whole = pa.concat_tables(tables).group_by("pair", use_threads=False).aggregate([("times", "sum")])
        pairs, times = whole["pair"].combine_chunks(), whole["times_sum"].combine_chunks()
        for lo in range(0, len(pairs), ROW):
            own = pairs[lo:lo + ROW], times[lo:lo + ROW]
            none = [pa.nulls(1, t) for t in (kind, *[pa.int64()] * 4, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([True]), *none, *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x.cast(pa.int64())) for x in own)], names=names)

    def run(batches):
        pair, held, size, kind = tokenizers(path_a, path_b), [], 0, None
        for batch in slices(batches):
            text = batch.column(1)
            text = pc.if_else(pc.greater(pc.binary_length(text), 0), pc.binary_join_element_wise(pa.scalar(" ", text.type), text, pa.scalar("", text.type)), None)
            kind = batch.column(0).type
            for lo, hi, data, offsets in parts_of(text, PIECE):
                starts, first = cuts(data, offsets)
                rows = pair.words.find(as_binary(data, starts))
                whole, _ = flat_ids(pair.words.take(rows, 2))
                bad = np.add.reduceat(np.append(1 - whole, 0), np.minimum(first[:-1], len(whole))) * (np.diff(first) > 0) > 0
                fine = np.repeat(~bad, np.diff(first))
                bounds = np.append(0, np.cumsum(np.where(bad, 0, np.diff(first))))
                tokens = []
                for k in (0, 1):
                    ids, by_word = flat_ids(pair.words.take(rows[fine], k))
                    tokens.append(pa.LargeListArray.from_arrays(pa.array(by_word[bounds]), pa.array(ids)))
                links = align(*tokens, *pair.sizes)
                at_a, at_b = links["at_a"].to_numpy(), links["at_b"].to_numpy()
                data, cut = written_groups(*tokens, at_a, at_b, pair)
                doc = links["doc"].to_numpy()
                n = hi - lo
                linked = np.bincount(doc, minlength=n)
                own = pa.table({"doc": links["doc"], "pair": pc.add(pc.multiply(links["a"], SHIFT), links["b"])})
                own = own.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]).sort_by("doc")
                spans = np.searchsorted(own["doc"].to_numpy(), np.arange(n + 1)).astype(np.int32)
                pairs, times = own["pair"].combine_chunks(), own["count_all"].combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(n, bool)), batch.column(0).slice(lo, n),
                     *(pa.array(np.diff(t.offsets.to_numpy())) for t in tokens), pa.array(linked), pa.array(linked),
                     pa.array([hashlib.sha256(data[a + 1:b]).hexdigest() if b > a else "" for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())], pa.string()),
                     pa.ListArray.from_arrays(pa.array(spans), pairs), pa.ListArray.from_arrays(pa.array(spans), times)], names=names)
                held.append(pa.table({"pair": pairs, "times": times}))
                size += len(pairs)
                if size >= FLUSH:
                    yield from counted(held, kind)
                    held, size = [], 0
        if held:
            yield from counted(held, kind)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return stored(docs.select("doc_id", "text").mapInArrow(
        run, f"part boolean, doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
             "pairs array<long>, times array<long>"), "align-docs")


def pair_counts(scanned: DataFrame) -> DataFrame:
    """pair, count (links of the whole corpus) and best: whether no pair with its B id has more."""
    pairs = stored(scanned.where("part").select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.*")
                   .groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count")), "align-pairs")
    b = F.pmod("pair", F.lit(SHIFT))
    most = pairs.groupBy(b.alias("b")).agg(F.max("count").alias("most"))        # a row per id of B
    return stored(pairs.join(F.broadcast(most), b == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "align-counts")


def frequent(counts: DataFrame, most: int) -> tuple[int, dict[str, np.ndarray]]:
    """The least count from which on there are at most ``most`` pairs (counts are looked at in
    quarters of an octave), and these pairs in order, with count and best."""
    level = F.floor(F.log2("count") * 4)
    by_level = sorted(((r["level"], r["n"]) for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()), reverse=True)
    total, least = 0, 1 << 12
    for k, n in by_level:       # a few hundred levels at most
        total += n
        if total > most:
            break
        least = k
    table = counts.where(level >= least).toArrow().combine_chunks()             # ``most`` rows at most
    order = np.argsort(table["pair"].to_numpy())
    return least, {c: table[c].to_numpy()[order] for c in ("pair", "count", "best")}


def report(docs: DataFrame, path_a: str, path_b: str, most: int = MOST) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    scanned = _scan(docs, path_a, path_b)
    counts = pair_counts(scanned)
    _, table = frequent(counts, most)
    sent = scanned.sparkSession.sparkContext.broadcast(table)
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    names = [*kept, "n_best", "count_sum", "pairs", "times"]

    def run(batches):
        for batch in slices(batches):
            known = sent.value
            lists, times = batch.column(len(kept)), batch.column(len(kept) + 1)
            pair, doc = pc.list_flatten(lists).to_numpy(zero_copy_only=False), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
            n = pc.list_flatten(times).to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(known["pair"], pair), max(len(known["pair"]) - 1, 0))
            hit = known["pair"][at] == pair if len(known["pair"]) else np.zeros(len(pair), bool)
            best, total = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            np.add.at(best, doc[hit], n[hit] * known["best"][at[hit]])
            np.add.at(total, doc[hit], n[hit] * known["count"][at[hit]])
            spans = pa.array(np.searchsorted(doc[~hit], np.arange(len(batch) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(best), pa.array(total),
                 pa.ListArray.from_arrays(spans, pa.array(pair[~hit])), pa.ListArray.from_arrays(spans, pa.array(n[~hit]))], names=names)

    kinds = ", ".join(f"{c} {scanned.schema[c].dataType.simpleString()}" for c in kept)
    met = stored(scanned.where("not part").select(*kept, "pairs", "times")
                 .mapInArrow(run, f"{kinds}, n_best long, count_sum long, pairs array<long>, times array<long>")
                 .withColumn("row", F.monotonically_increasing_id()), "align-met")
    rest = met.where(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.*")
    found = (rest.join(counts, F.col("pairs") == F.col("pair")).groupBy(F.col("row").alias("_row"))
             .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"), F.sum(F.col("times") * F.col("count")).alias("_sum")))
    return (met.drop("pairs", "times").join(found, F.col("row") == F.col("_row"), "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
                    (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"), "groups_sha256"))
