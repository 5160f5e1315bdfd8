"""Best-fit packing of tokenised documents by bin completion.

Documents are encoded, closed by an end id and cut into pieces of at most ``capacity`` tokens; the
pieces are packed into as few sequences of that capacity as the search finds.

What decides a packing are the lengths alone: how many pieces there are of each of the ``capacity``
possible lengths.  So Spark counts the pieces of each length, and the search works on those counts
(at most ``capacity`` numbers, however many documents), filling many alike sequences in one step.
A step takes the largest length left and completes its sequence: the undominated fillings of the
room beside it are enumerated (a filling is dominated if a piece, or some of its pieces together,
can be exchanged for one larger piece that is left and fits), best first.  A branch is given up when
its waste exceeds what a better packing could afford, or when the lower bound of what is left
(Martello and Toth's L2) leads to no fewer sequences than the best packing known.  The first of
these is best-fit decreasing; it stands if the search, which ends after ``steps`` steps, finds
no better one.

The packing is a short list of fillings and how often each is used.  It gives every piece its
place by its number among the pieces of its length: tasks number their own pieces while they
encode, and running sums over (task, length) make the numbers continue.  No piece is sorted or
gathered with others, whatever the distribution of lengths.

Cases: a null or empty text is its end id alone; texts are taken whole, longer documents are cut
into pieces of ``capacity`` tokens and a shorter last one; repeated rows are documents of their
own; a null doc_id is carried on; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import byte_alphabet
from .common import stored
from .textscan import pieces as parts_of
from .textscan import slices
from .words import WordIds, flat_ids, one_by_one, runs

#: Bytes of text encoded at once.
PIECE = 1 << 21
#: The character of each byte but the blank, which parts runs.
SHOWN = {b: c for b, c in enumerate(byte_alphabet()) if b != 0x20}
#: Partial fillings looked at and fillings kept in one step, and steps of the search.
LOOKED, WIDTH, STEPS = 100, 8, 5000

Filling = tuple[tuple[int, int], ...]       # (length, how many), lengths descending


# --------------------------------------------------------------------------------------------
# The search, on counts of lengths
# --------------------------------------------------------------------------------------------
def lower_bound(n: np.ndarray, capacity: int) -> int:
    """Martello and Toth's L2: sequences that pieces of these counts need at least."""
    sizes = np.arange(capacity + 1)
    count, total = np.cumsum(n), np.cumsum(n * sizes)
    half = capacity // 2
    k = np.arange(half + 1)
    large = count[-1] - count[half]                        # more than half: one sequence each
    room = capacity * (count[capacity - k] - count[half]) - (total[capacity - k] - total[half])
    below = np.where(k > 0, total[np.maximum(k - 1, 0)], 0)
    rest = np.maximum(total[half] - below - room, 0)
    return int(large + (-(-rest // capacity)).max())


def best_fit(n: np.ndarray, capacity: int) -> list[tuple[int, Filling]]:
    """Best-fit decreasing on counts: (how often, filling)."""
    open_: dict[int, list[tuple[int, Filling]]] = {}       # by room left
    done = []

    def put(room, times, filling):
        if times and room:
            open_.setdefault(room, []).append((times, filling))
        elif times:
            done.append((times, filling))

    for size in range(capacity, 0, -1):
        left = int(n[size])
        while left:
            room = min((r for r in open_ if r >= size), default=None)
            times, filling = (1 << 62, ()) if room is None else open_[room].pop()
            if room is not None and not open_[room]:
                del open_[room]
            room = capacity if room is None else room
            each = room // size
            used = min(times, left // each)
            put(room - each * size, used, (*filling, (size, each)))
            left -= used * each
            if used < times and 0 < left < each:
                put(room - left * size, 1, (*filling, (size, left)))
                used, left = used + 1, 0
            if filling:
                put(room, times - used, filling)
    return done + [g for groups in open_.values() for g in groups]


def fillings(n: np.ndarray, room: int, most_waste: int) -> list[tuple[int, Filling]]:
    """(waste, filling) of the undominated ways to fill ``room`` from the counts ``n``, best first."""
    have = np.flatnonzero(n[:room + 1])
    if not len(have) or room == 0:
        return [(room, ())] if room <= most_waste else []
    if have[-1] == room:        # one piece that fits exactly dominates all others
        return [(0, ((room, 1),))]
    fits = np.zeros(room + 1, np.int64)         # the largest length left up to each size
    fits[have] = have
    fits = np.maximum.accumulate(fits).tolist()
    have, left = have.tolist(), n[:room + 1].tolist()
    found: list[tuple[int, Filling]] = []
    looked = 0

    def left_of(size: int, filling: Filling) -> bool:
        """Whether a piece of this length is left beside the filling."""
        if size > room or not left[size]:
            return False
        return all(size != other or left[size] > k for other, k in filling)

    def dominated(filling: Filling, waste: int) -> bool:
        sums = {0: 0}           # sum of some pieces of the filling -> fewest pieces
        for size, k in filling:
            for _ in range(min(k, 3)):
                if len(sums) < 64:
                    sums |= {s + size: c + 1 for s, c in sums.items() if s + size not in sums}
        for s, c in sums.items():
            y = fits[min(s + waste, room)]
            if (y > s or y == s and c > 1) and left_of(y, filling):
                return True
        return False

    def extend(room_left: int, limit: int, filling: Filling) -> None:
        """Maximal fillings that go on with lengths up to ``limit``, the largest first.  Two pieces
        whose sum is a length that is left are dominated by it, whatever is added."""
        nonlocal looked
        looked += 1
        if not fits[min(room_left, limit)]:
            if room_left <= most_waste and not dominated(filling, room_left):
                found.append((room_left, filling))
            return
        for at in range(bisect_right(have, min(room_left, limit)) - 1, -1, -1):
            size = have[at]
            if any(left_of(size + other, filling) for other, _ in filling):
                continue
            most = min(room_left // size, left[size])
            for k in range(min(most, 1) if left_of(2 * size, filling) else most, 0, -1):
                if looked >= LOOKED:
                    return
                extend(room_left - k * size, size - 1, (*filling, (size, k)))

    extend(room, room, ())
    if not found and looked >= LOOKED:      # what largest-first gives
        rest, filling = room, []
        for size in reversed(have):
            if k := min(rest // size, left[size]):
                filling.append((size, k))
                rest -= k * size
        found = [(rest, tuple(filling))] if rest <= most_waste else []
    return sorted(found, key=lambda x: x[0])[:WIDTH]


def pack_counts(n: np.ndarray, capacity: int, steps: int = STEPS) -> list[tuple[int, Filling]]:
    """(how often, filling) of the best packing found; ``n[s]``: pieces of length s."""
    n = np.array(n, np.int64)
    best = best_fit(n, capacity)
    fewest, least = sum(t for t, _ in best), lower_bound(n, capacity)
    total = int((n * np.arange(capacity + 1)).sum())
    chosen: list[tuple[int, Filling]] = []

    def options(used: int, waste: int) -> Iterator[tuple[int, int, Filling]]:
        """(how often, waste, filling with the largest piece) of each branch of this node."""
        size = int(np.flatnonzero(n)[-1])
        n[size] -= 1
        allowed = (fewest - 1) * capacity - total - waste
        ways = fillings(n, capacity - size, allowed)
        n[size] += 1
        for single in (False, True):
            for lost, filling in ways:
                whole = dict(filling)
                whole[size] = whole.get(size, 0) + 1
                whole = tuple(sorted(whole.items(), reverse=True))
                times = min(int(n[s]) // k for s, k in whole)
                if lost:        # no more often than the waste allows
                    times = min(times, max(1, allowed // lost))
                if not single:
                    yield times, lost, whole
                elif times > 1 and not (len(ways) == 1 and lost == 0):
                    yield 1, lost, whole

    if fewest == least or not total:
        return best
    used = waste = taken = 0
    stack = [options(0, 0)]
    while stack and taken < steps and fewest > least:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if chosen:
                times, whole, lost = chosen.pop()
                for s, k in whole:
                    n[s] += times * k
                used, waste = used - times, waste - times * lost
            continue
        times, lost, whole = step
        taken += 1
        if waste + times * lost > (fewest - 1) * capacity - total:
            continue
        for s, k in whole:
            n[s] -= times * k
        if used + times + lower_bound(n, capacity) >= fewest:
            for s, k in whole:
                n[s] += times * k
            continue
        used, waste = used + times, waste + times * lost
        chosen.append((times, whole, lost))
        if n.any():
            stack.append(options(used, waste))
        else:
            best, fewest = [(t, w) for t, w, _ in chosen], used
            stack.append(iter(()))
    return best


def places(packing: list[tuple[int, Filling]]) -> dict[str, np.ndarray]:
    """Rows (length, first number, each, sequence, offset), ordered by length and first number: the
    pieces of a length from a number on lie ``each`` to a sequence, from ``sequence`` on, the
    first at ``offset``."""
    rows, numbered, sequence = [], {}, 0
    for times, filling in packing:
        offset = 0
        for size, each in filling:
            first = numbered.get(size, 0)
            rows.append((size, first, each, sequence, offset))
            numbered[size] = first + times * each
            offset += size * each
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "each", "sequence", "offset"), table.T.copy()))


def placed(table: dict[str, np.ndarray], length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces with these lengths and numbers."""
    key = (table["length"] << 44) + table["first"]
    at = np.searchsorted(key, (length << 44) + number, side="right") - 1
    on = number - table["first"][at]
    return table["sequence"][at] + on // table["each"][at], table["offset"][at] + on % table["each"][at] * length


# --------------------------------------------------------------------------------------------
# The documents
# --------------------------------------------------------------------------------------------
@lru_cache(maxsize=2)
def word_ids(path: str, end: int) -> tuple[WordIds, WordIds]:
    """Runs of letters, digits or signs, and whole words, of a tokenizer file that lower-cases and marks
    ends of words (row 0 of the first: the end id); one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    tok, bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
    # runs need neither normalising nor cutting: they come as byte-level characters between blanks
    bare.normalizer = normalizers.Sequence([])
    bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    mark = bare.model.end_of_word_suffix
    last = np.zeros(bare.get_vocab_size(), bool)
    last[[i for t, i in bare.get_vocab().items() if t.endswith(mark)]] = True

    def in_runs(runs):
        flat, sizes = [], []
        for lo in range(0, len(runs), 2048):
            text = b" ".join(runs[lo:lo + 2048]).decode("latin-1").translate(SHOWN)
            ids = np.array(bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            flat.append(ids)
            sizes.append(np.diff(np.append(-1, np.flatnonzero(last[ids]))))
        return ((np.concatenate(flat), np.concatenate(sizes)),)

    def whole(words):
        out = []
        for lo in range(0, len(words), 1024):
            texts = [w.decode("utf-8", "replace") for w in words[lo:lo + 1024]]
            out += [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
        return (one_by_one(out),)

    return WordIds(in_runs, 1, ((end,),)), WordIds(whole, 1)


def encoded(column: pa.Array, path: str, end: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, ids with each row's end id, bounds of the rows), a part at a time."""
    of_runs, of_words = word_ids(path, end)
    for lo, hi, data, offsets in parts_of(column, PIECE):
        found, whole, first = runs(data, offsets)
        row = np.zeros(len(found), np.int64)
        row[~whole] = of_runs.find(found.filter(pa.array(~whole)))
        other = of_words.find(found.filter(pa.array(whole)))
        lists = of_runs.take(np.insert(row, first[1:], 0), 0)
        ids, bounds = flat_ids(lists)
        if whole.any():         # their ids take the place of the end id that stands for them
            more, cut = flat_ids(of_words.take(other, 0))
            at = np.flatnonzero(whole) + np.searchsorted(first[1:], np.flatnonzero(whole), side="right")
            size = np.diff(bounds)
            size[at] = np.diff(cut)
            new = np.append(0, np.cumsum(size))
            out = np.empty(new[-1], ids.dtype)
            own = np.zeros(len(size), bool)
            own[at] = True
            out[np.repeat(own, size)] = more
            out[~np.repeat(own, size)] = ids[~np.repeat(own, np.diff(bounds))]
            ids, bounds = out, new
        yield lo, hi, ids.astype("<u4"), bounds[first + np.arange(len(first))]


def pieces(docs: DataFrame, path: str, end: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, task and nth (number of the piece among those of its
    length in its task), and the ids if ``with_ids``, in the shared folder."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", *(["ids"] if with_ids else [])]

    def run(batches):
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches):
            for lo, hi, ids, bounds in encoded(batch.column(1), path, end):
                row, start, length, crc, nth, held = [], [], [], [], [], []
                for r, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    for at in range(a, b, capacity):
                        own = ids[at:min(at + capacity, b)]
                        row.append(lo + r)
                        start.append(at - a)
                        length.append(len(own))
                        crc.append(zlib.crc32(own.tobytes()))
                        nth.append(int(seen[len(own)]))
                        seen[len(own)] += 1
                        if with_ids:
                            held.append(own.astype(np.int32))
                start = np.array(start, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row, pa.int64())), pa.array((start // capacity).astype(np.int32)), pa.array(start),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(np.full(len(row), task, np.int32)),
                     pa.array(nth, pa.int64()), *([pa.array(held, pa.list_(pa.int32()))] if with_ids else [])], names=names)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, task int, nth long"
    return stored(docs.select("doc_id", "text").mapInArrow(run, schema + (", ids array<int>" if with_ids else "")), "pack-pieces")


def pack(docs: DataFrame, path: str, end: int = 0, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs``
    (doc_id, text), and the ids if ``with_ids``."""
    rows = pieces(docs, path, end, capacity, with_ids)
    counts = stored(rows.groupBy("task", "length").agg(F.count("*").alias("n")), "pack-counts")
    n = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():        # at most ``capacity`` rows
        n[r["length"]] = r["n"]
    table = rows.sparkSession.sparkContext.broadcast(places(pack_counts(n, capacity)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    began = counts.select(F.col("task").alias("_task"), F.col("length").alias("_length"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rows = (rows.join(began, (F.col("task") == F.col("_task")) & (F.col("length") == F.col("_length")))
            .withColumn("number", F.col("before") + F.col("nth")))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names)

    def run(batches):
        for batch in batches:
            sequence, offset = placed(table.value, batch.column(3).to_numpy(), batch.column(batch.num_columns - 1).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                                             names=[*names, "sequence_id", "offset"])

    return rows.select(*names, "number").mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of every sequence, from pieces packed with their ids; a sequence is one
    group of at most ``capacity`` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
