"""Token ids of whole texts from the ids of their distinct words.

Subword encoders work on words by themselves: no match of their patterns, and no piece of their
vocabularies, goes on over a blank that follows a visible character.  A text is cut there, each
distinct word of a part is encoded by the library once (and remembered, up to KEPT words), and the
text's ids are gathered from them with one Arrow ``take``.  The ids are those of the whole text.

A blank is only a cut where the character before it is certainly no white space: an ASCII one that
is visible, or one of two UTF-8 bytes from U+00C0 on.  Elsewhere the word just goes on.

``runs`` cuts further, for encoders that lower-case, drop white space and take letters, single digits
and other characters apart (with the English endings 's 't 're 've 'm 'll 'd): words of ASCII and
Latin-1 letters fall into such runs, in lower case; any other word stays whole.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words, and ids of words, remembered between parts of a task.
KEPT = 1 << 18
VISIBLE = np.zeros(256, dtype=bool)
VISIBLE[0x21:0x7F] = True
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Kinds of bytes: 1 letter, 2 digit, 3 other visible character, 0 blank.
KIND = np.where(VISIBLE, 3, 0)
KIND[0x30:0x3A] = 2
KIND[0x41:0x5B] = KIND[0x61:0x7B] = 1
LATIN = 0xC3            # first byte of U+00C0 to U+00FF, letters but for two signs


def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word, and the index of the first word of each row (one entry more than
    rows).  Words but a row's first begin with a blank and have something after it."""
    n = len(data)
    begins = np.zeros(n + 1, dtype=bool)
    at = np.flatnonzero(data[1:-1] == 0x20) + 1
    begins[at[safe_end(data, at)]] = True
    last = offsets[1:] - 1      # a row's last byte is no word of its own
    begins[last[last >= 0]] = False
    begins[offsets] = True
    starts = np.flatnonzero(begins[:n])
    return starts, np.searchsorted(starts, offsets)


def safe_end(data: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether the character that ends at each place is certainly no white space."""
    before, lead = data[end - 1], data[np.maximum(end - 2, 0)]
    return VISIBLE[before] | ((before >= 0x80) & (lead >= 0xC3) & (lead <= 0xDF))


def as_binary(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The words as a binary column over the same bytes."""
    bounds = np.append(starts, len(data)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The runs of all rows, whether each is a whole word that was left as it is, and the index of the
    first run of each row (one entry more than rows)."""
    n = len(data)
    starts, _ = cuts(data, offsets)
    if not n:
        return as_binary(data, starts), np.zeros(0, bool), np.zeros(len(offsets), np.int64)
    kind, low = KIND[data], data.copy()
    low[(data >= 0x41) & (data <= 0x5A)] += 0x20
    first = np.flatnonzero(data[:-1] == LATIN)
    second = data[first + 1]
    sign = (second == 0x97) | (second == 0xB7)
    fine = (second >= 0x80) & (second <= 0xBF)
    kind[first[fine]] = kind[first[fine] + 1] = np.where(sign[fine], 3, 1)
    up = first[(second >= 0x80) & (second <= 0x9E) & ~sign] + 1
    low[up] += 0x20
    # words with any other byte, and those that may hold a special token, stay whole
    odd = (kind == 0) & ~BLANK[data]
    odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    word = np.zeros(n, np.int64)
    word[starts] = 1
    word = np.cumsum(word) - 1
    whole = np.zeros(len(starts), bool)
    whole[word[odd]] = True
    in_whole = whole[word]
    # a run begins where the kind changes, and at each digit
    second_byte = np.zeros(n, bool)
    second_byte[first[fine] + 1] = True
    begins = np.empty(n, bool)
    begins[0] = True
    begins[1:] = kind[1:] != kind[:-1]
    begins |= kind == 2
    begins[starts] = True
    # 's 't 're 've 'm 'll 'd: one apostrophe between other kinds, and these letters
    mark = np.flatnonzero((low[:-1] == 0x27) & begins[:-1] & begins[1:] & (kind[1:] == 1) & (word[1:] == word[:-1]))
    a = low[mark + 1]
    b = np.where(mark + 2 < n, low[np.minimum(mark + 2, n - 1)], 0)
    one = (a == 0x73) | (a == 0x74) | (a == 0x6D) | (a == 0x64)
    two = ((a == 0x72) & (b == 0x65)) | ((a == 0x76) & (b == 0x65)) | ((a == 0x6C) & (b == 0x6C))
    two &= ~begins[np.minimum(mark + 2, n - 1)] | (mark + 2 >= n)       # both in one run
    hit = one | two
    begins[mark[hit] + 1] = False
    after = mark + np.where(one, 2, 3)
    begins[after[hit & (after < n)]] = True
    begins = np.where(in_whole, False, begins & (kind != 0))
    begins[starts[whole]] = True
    kept = in_whole | (kind != 0)
    at = np.cumsum(kept) - kept
    runs_at = np.flatnonzero(begins)
    bytes_ = np.where(in_whole, data, low)[kept]
    return as_binary(bytes_, at[runs_at]), in_whole[runs_at], np.searchsorted(runs_at, offsets)


Encoded = tuple[np.ndarray, np.ndarray]     # ids of all words in order, and how many each word has


def one_by_one(lists: list[list[int]]) -> Encoded:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.array([x for ids in lists for x in ids], np.int32), sizes


def by_bytes(words: list[bytes], encode: Callable[[bytes], list[int]], sizes: np.ndarray) -> Encoded | None:
    """Ids of words that are encoded as one text, told apart by the ``sizes`` (bytes) of the ids;
    nothing if the ids do not cover the text or go over a word's end."""
    ids = np.array(encode(b"".join(words)), np.int64)
    ends, through = np.cumsum(sizes[ids]), np.cumsum([len(w) for w in words])
    at = np.searchsorted(ends, through)
    if not len(ids) or ends[-1] != through[-1] or (ends[at] != through).any():
        return None
    return ids.astype(np.int32), np.diff(np.append(0, at + 1))


class WordIds:
    """Ids of words by ``encode`` (list of words -> ``Encoded`` per column).  Row 0 has the ids
    ``first`` (per column), for ends of documents and the like."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[Encoded, ...]], columns: int, first: tuple = ()):
        self.encode, self.columns, self.first = encode, columns, first
        self.clear()

    def clear(self):
        self.rows: dict[bytes, int] = {}
        self.flat = [np.array(self.first[k] if self.first else [], np.int32) for k in range(self.columns)]
        self.bounds = [np.array([0, len(x)], np.int64) for x in self.flat]

    def add(self, words: list[bytes]) -> None:
        for k, (flat, sizes) in enumerate(self.encode(words)):
            self.bounds[k] = np.append(self.bounds[k], self.bounds[k][-1] + np.cumsum(sizes))
            self.flat[k] = np.concatenate([self.flat[k], flat])
        n = len(self.rows) + 1
        self.rows.update(zip(words, range(n, n + len(words))))

    def find(self, words: pa.Array) -> np.ndarray:
        """Row of each word, encoding those that are new."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.rows) + len(distinct) > KEPT or sum(map(len, self.flat)) > 8 * KEPT:
            self.clear()
        new = [w for w in distinct if w not in self.rows]
        if new:
            self.add(new)
        row = np.fromiter(map(self.rows.__getitem__, distinct), np.int64, len(distinct))
        return row[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)

    def take(self, rows: np.ndarray, column: int) -> pa.LargeListArray:
        """A list of ids per entry of ``rows``."""
        kept = pa.LargeListArray.from_arrays(pa.array(self.bounds[column]), pa.array(self.flat[column]))
        return pc.take(kept, pa.array(rows))


def flat_ids(lists: pa.LargeListArray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the lists in order, and the bounds of each list."""
    bounds = lists.offsets.to_numpy()
    return pc.list_flatten(lists).to_numpy(), bounds - bounds[0]
