"""Quality classifier: a generalised additive model with pairwise interactions.

Every text gives a few figures of its form (``FIGURES``).  The model is a lookup table per figure
and per chosen pair of figures, learned by cyclic gradient boosting: in every round each figure in
turn gets a tree of a few leaves on its bins, whose leaf values, damped, are added to the figure's
table; then pairs, chosen by the loss that they could still take away, get tables of four leaves
the same way.  A score is the sigmoid of the sum of the tables' entries, looked up for whole
batches at once.

Training: at most about ``max_rows`` labelled rows (bound of the sample and of what reaches the
driver: 8 bytes a figure and row), chosen by a hash of the id; their labels are broadcast, their
texts are scanned where they lie.  Scoring is one pass over whole texts without a shuffle.

Cases: null texts are scored as empty ones; null labels, and labels of unknown documents, are not
learned from; several labels of a document all count; ties and repeated rows have the same score;
with nothing to learn from every score is 0.5; other columns are ignored, or kept by ``keep_good``;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textscan import pieces, slices, word_bounds, word_hashes

FIGURES = [
    "log_words", "word_length", "upper", "digits", "marks", "other_symbols", "blanks", "high_bytes",
    "distinct_words", "top_word", "repeated_next", "words_with_symbol", "upper_words", "log_lines",
    "distinct_lines", "longest_word", "mark_kinds", "distinct_bigrams"]
_bytes = np.arange(256)
_UPPER = (_bytes >= 65) & (_bytes <= 90)
_DIGIT = (_bytes >= 48) & (_bytes <= 57)
_MARK = np.isin(_bytes, list(b".,;:!?'\"()-"))
_LETTER = _UPPER | ((_bytes >= 97) & (_bytes <= 122))
_SYMBOL = (_bytes > 32) & (_bytes < 127) & ~_LETTER & ~_DIGIT & ~_MARK
_BLANK = (_bytes == 32) | ((_bytes >= 9) & (_bytes <= 13))
_HIGH = _bytes >= 128


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _distinct(keys: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each row, and how often its most frequent one occurs."""
    kinds, most = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    if len(keys):
        order = np.lexsort((keys, row))
        k, r = keys[order], row[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
        at = np.flatnonzero(new)
        kinds += np.bincount(r[at], minlength=rows)
        np.maximum.at(most, r[at], np.diff(np.append(at, len(k))))
    return kinds, most


def figures(column: pa.Array) -> np.ndarray:
    """The figures of every text of a column: [rows, len(FIGURES)]."""
    out = [np.zeros((0, len(FIGURES)))]
    for lo, hi, data, offsets in pieces(column):
        rows = hi - lo
        size = np.maximum(np.diff(offsets), 1)
        starts, ends, first = word_bounds(data, offsets)
        n = np.diff(first)
        some, row = np.maximum(n, 1), np.repeat(np.arange(rows), n)
        h = word_hashes(data, starts, ends)
        length = ends - starts
        share = lambda table: _per_row(table[data], offsets) / size
        kinds, most = _distinct(h, row, rows)
        inside = row[1:] == row[:-1]
        next_same = inside & (h[1:] == h[:-1]) if len(h) > 1 else np.zeros(0, bool)
        pairs = h[:-1] * np.uint64(3) + h[1:] if len(h) > 1 else np.zeros(0, np.uint64)
        pair_kinds, _ = _distinct(pairs[inside], row[:-1][inside], rows)
        odd = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_SYMBOL[data], out=odd[1:])
        caps = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_UPPER[data], out=caps[1:])
        with_symbol = (odd[ends] - odd[starts]) > 0
        shouted = (caps[ends] - caps[starts]) >= 2
        # lines: the positions after which a line ends, and a hash of each line's words
        cut = np.zeros(len(data) + 1, np.int64)
        np.cumsum(data == 10, out=cut[1:])
        line = cut[starts]
        begin = np.ones(len(line), bool)
        begin[1:] = (line[1:] != line[:-1]) | ~inside
        at = np.flatnonzero(begin)
        place = (np.arange(len(h)) - np.repeat(at, np.diff(np.append(at, len(h)))) + 1).astype(np.uint64)
        lines = np.add.reduceat(h * (place * np.uint64(2) + np.uint64(1)), at) if len(at) else np.zeros(0, np.uint64)
        n_lines = np.bincount(row[at], minlength=rows)
        line_kinds, _ = _distinct(lines, row[at], rows)
        longest = np.zeros(rows, np.int64)
        np.maximum.at(longest, row, length)
        symbol_kinds = np.zeros(rows)
        for b in b"#%&*$@^~|<>{}[]=+_\\/!":
            symbol_kinds += _per_row(data == b, offsets) > 0
        out.append(np.column_stack([
            np.log1p(n), np.bincount(row, length, rows) / some, share(_UPPER), share(_DIGIT), share(_MARK),
            share(_SYMBOL), share(_BLANK), share(_HIGH), kinds / some, most / some,
            np.bincount(row[1:][next_same] if len(h) > 1 else row[:0], minlength=rows) / some,
            np.bincount(row, with_symbol, rows) / some, np.bincount(row, shouted, rows) / some,
            np.log1p(n_lines), line_kinds / np.maximum(n_lines, 1), np.log1p(longest), symbol_kinds,
            pair_kinds / np.maximum(n - 1, 1)]))
    return np.concatenate(out)


def _best_split(g: np.ndarray, h: np.ndarray, least: float) -> tuple[float, int]:
    """Gain and place (bins up to it go left) of the best cut of a run of bins."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = np.where((hl > least) & (hr > least), gl**2 / (hl + 1) + gr**2 / (hr + 1), -np.inf)
    if not len(gain) or not np.isfinite(gain).any():
        return 0.0, -1
    k = int(np.argmax(gain))
    return float(gain[k] - g.sum()**2 / (h.sum() + 1)), k


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """Value for each bin of a tree of at most ``leaves`` leaves grown on the bins' sums."""
    runs = [(0, len(g))]
    while len(runs) < leaves:
        gains = [_best_split(g[a:b], h[a:b], least) for a, b in runs]
        best = max(range(len(runs)), key=lambda i: gains[i][0])
        if gains[best][0] <= 1e-6:
            break
        a, b = runs.pop(best)
        runs += [(a, a + gains[best][1] + 1), (a + gains[best][1] + 1, b)]
    out = np.zeros(len(g))
    for a, b in runs:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, least: float) -> tuple[np.ndarray, float]:
    """Values of a two-level tree on a grid of bins (one cut of the rows, one of the columns on
    either side), and its gain."""
    best, table = 0.0, np.zeros_like(g)
    _, row = _best_split(g.sum(1), h.sum(1), least)
    rows = {row, *np.linspace(0, len(g) - 2, min(len(g) - 1, 6)).astype(int)} - {-1}
    for k in rows:
        values, gain = np.zeros_like(g), 0.0
        for part in (slice(0, k + 1), slice(k + 1, len(g))):
            gs, hs = g[part].sum(0), h[part].sum(0)
            values[part] = _tree(gs, hs, 2, least)
            v = values[part][0]
            gain += float((2 * gs * v - hs * v * v).sum())
        if gain > best:
            best, table = gain, values
    return table, best


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, pair_bins: int = 12, rounds: int = 250,
        pair_rounds: int = 80, pairs: int = 6, leaves: int = 3, rate: float = 0.1, least: float = 0.5) -> dict:
    """Edges, tables, pairs and intercept from figures and 0/1 labels."""
    f = x.shape[1]
    prior = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(prior / (1 - prior)))
    quantiles = lambda j, n: np.unique(np.quantile(x[:, j], np.linspace(0, 1, n + 1)[1:-1])) if len(x) else np.zeros(0)
    edges = [quantiles(j, bins) for j in range(f)]
    coarse = [quantiles(j, pair_bins) for j in range(f)]
    where = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = {"base": base, "edges": edges, "tables": tables, "coarse": coarse, "pairs": []}
    if len(y) < 10 or y.min() == y.max():
        return model
    z = np.full(len(y), base)
    step = lambda: (lambda p: (y - p, p * (1 - p)))(1 / (1 + np.exp(-z)))
    for _ in range(rounds):
        for j in range(f):
            g, h = step()
            n = len(tables[j])
            t = rate * _tree(np.bincount(where[j], g, n), np.bincount(where[j], h, n), leaves, least)
            tables[j] += t
            z += t[where[j]]
    flat = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]
    grid = lambda a, b, v: np.bincount(flat[a] * (len(coarse[b]) + 1) + flat[b], v, (len(coarse[a]) + 1) * (len(coarse[b]) + 1)).reshape(len(coarse[a]) + 1, -1)
    g, h = step()
    found = sorted(((_quadrants(grid(a, b, g), grid(a, b, h), least)[1], a, b) for a in range(f) for b in range(a + 1, f)), reverse=True)
    chosen = [(a, b) for gain, a, b in found[:pairs] if gain > 1e-3]
    planes = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in chosen]
    for _ in range(pair_rounds):
        for (a, b), plane in zip(chosen, planes):
            g, h = step()
            t = rate * _quadrants(grid(a, b, g), grid(a, b, h), least)[0]
            plane += t
            z += t[flat[a], flat[b]]
    model["pairs"] = [(a, b, p) for (a, b), p in zip(chosen, planes)]
    return model


def score(x: np.ndarray, model: dict) -> np.ndarray:
    """Probability of label 1 of each row of figures."""
    z = np.full(len(x), model["base"])
    for j, (e, t) in enumerate(zip(model["edges"], model["tables"])):
        z += t[np.searchsorted(e, x[:, j], "right")]
    for a, b, p in model["pairs"]:
        z += p[np.searchsorted(model["coarse"][a], x[:, a], "right"), np.searchsorted(model["coarse"][b], x[:, b], "right")]
    return 1 / (1 + np.exp(-z))


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, max_rows: int = 25_000, **how) -> dict:
    """Model from the rows of ``docs`` (doc_id, text) that have a label (doc_id, quality) and for
    whose doc_id ``learnable`` holds."""
    known = labels.select("doc_id", "quality").where(learnable & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    n = known.count()
    rank = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    known = known.where(rank <= int((1 << 30) * min(1.0, max_rows / max(n, 1))))
    # about max_rows rows of two numbers: a bound, so they may be broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "quality")

    def run(batches):
        for batch in slices(batches):
            x = figures(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), pa.list_(pa.float64())), batch.column(1).cast(pa.int64())], names=["x", "y"])

    got = rows.mapInArrow(run, "x array<double>, y long").toPandas()
    x = np.array(got["x"].tolist(), float).reshape(-1, len(FIGURES))
    y = (got["y"].to_numpy(float) > 0).astype(float)
    order = np.lexsort((*x.T, y))           # the same model however the rows arrive
    return fit(x[order], y[order], **how)


def classify(docs: DataFrame, model: dict, held_out: Column, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from a score of ``least``) of every row."""

    def run(batches):
        for batch in slices(batches):
            p = score(figures(batch.column(2)), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p, pa.float64()),
                 pa.array((p >= least).astype(np.int32), pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        run, f"doc_id {id_type}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: dict, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` scored at least ``least``, all columns kept."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in slices(batches):
            yield batch.filter(pa.array(score(figures(batch.column(at)), model) >= least))

    return docs.mapInArrow(run, docs.schema)
