"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A rank file (one base-64 token and its rank per line) becomes a tokenizers BPE model: each byte is
written as the character that the byte-level alphabet gives it, and every way to cut a token into
two known tokens is a merge, ordered by the token's rank, so that the lowest rank merges first.
Text is cut by the published pattern and each match is encoded by itself; no special tokens.  With
the library's own pattern no match goes on over a blank after a visible character (``words``), nor over a
change between ASCII letters, digits and other characters, but for the apostrophe before a letter.  The
distinct words between such places are encoded by the library and remembered, and a text's ids are
gathered from theirs.

Decoding maps ids to token bytes with two numpy gathers (byte table and offsets).  A character may
be split over several tokens, so only the bytes of a whole text are read as UTF-8.

Character offsets: tokens give byte spans; bytes that do not continue a character are counted by a
running sum, so that a token's span covers every character that it touches.

Cases: a null text is encoded as the empty one (no ids); text of any length is encoded whole;
repeated rows are encoded row by row; other columns are passed through or ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from .textscan import pieces, slices
from .words import KIND, WordIds, as_binary, cuts, flat_ids, one_by_one

#: The pattern built into the tokenizers library's byte-level step, which is the faster way for it.
BUILT_IN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of text encoded at once: whole texts, so that the library's objects stay small, and words.
PIECE, WORDS_PIECE = 1 << 17, 1 << 20
#: Words that are one match of the built-in pattern.
ONE_MATCH = re.compile(rb" ?(?:[A-Za-z]+|[0-9]+|[!-/:-@\[-`{-~]+)")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, the others from
    U+0100 on in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str):
    """The tokenizers encoder of a rank file; one thread, as Spark runs a task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, alphabet = vocabulary(path), byte_alphabet()
    shown = {t: "".join(alphabet[b] for b in t) for t in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        cuts = [(token[:k], token[k:]) for k in range(1, len(token))]
        cuts = [c for c in cuts if c[0] in ranks and c[1] in ranks]
        merges += [(shown[a], shown[b]) for a, b in sorted(cuts, key=lambda c: (ranks[c[0]], ranks[c[1]]))]
    model = models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
    out = Tokenizer(model)
    steps = [pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=pattern == BUILT_IN)]
    if pattern != BUILT_IN:
        steps.insert(0, pre_tokenizers.Split(Regex(pattern), behavior="isolated"))
    out.pre_tokenizer = pre_tokenizers.Sequence(steps)
    return out


@lru_cache(maxsize=2)
def byte_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """All tokens' bytes in id order and the offsets of each id (ids without a token are empty)."""
    ranks = vocabulary(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for t, r in ranks.items():
        tokens[r] = t
    offsets = np.zeros(len(tokens) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in tokens], out=offsets[1:])
    return np.frombuffer(b"".join(tokens), dtype=np.uint8), offsets


def decode(ids: np.ndarray, path: str) -> bytes:
    """Bytes of a run of ids."""
    data, offsets = byte_table(path)
    ids = np.asarray(ids, dtype=np.int64)
    lengths = offsets[ids + 1] - offsets[ids]
    ends = np.cumsum(lengths)
    where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets[ids] - ends + lengths, lengths)
    return data[where].tobytes()


def char_spans(ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and last character + 1 that each token touches."""
    _, offsets = byte_table(path)
    ids = np.asarray(ids, dtype=np.int64)
    data = np.frombuffer(decode(ids, path), dtype=np.uint8)
    begun = np.zeros(len(data) + 1, dtype=np.int64)     # characters begun before each byte
    np.cumsum((data & 0xC0) != 0x80, out=begun[1:])
    ends = np.cumsum(offsets[ids + 1] - offsets[ids])
    starts = ends - (offsets[ids + 1] - offsets[ids])
    if not len(ids):
        return starts, ends
    return begun[starts + 1] - 1, begun[ends]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """Ids of words for the built-in pattern, by the library: a word of one match by its model, any other by
    pattern and model."""
    tok = encoder(path, BUILT_IN)
    model, shown = tok.model, dict(enumerate(byte_alphabet()))

    def run(words):
        ids = [[t.id for t in model.tokenize(w.decode("latin-1").translate(shown))] if ONE_MATCH.fullmatch(w) else None for w in words]
        rest = [k for k, x in enumerate(ids) if x is None]
        for k, e in zip(rest, tok.encode_batch_fast([words[k].decode() for k in rest], add_special_tokens=False)):
            ids[k] = e.ids
        return (one_by_one(ids),)

    return WordIds(run, 1)


def word_cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``words.cuts``, and cuts where one of the built-in pattern's matches ends beside ASCII characters."""
    starts, _ = cuts(data, offsets)
    begins = np.zeros(len(data), bool)
    begins[starts] = True
    kind, after = KIND[data[:-1]], KIND[data[1:]]
    begins[1:] |= (kind != after) & (kind > 0) & (after > 0) & ~((data[:-1] == 0x27) & (after == 1))
    starts = np.flatnonzero(begins)
    return starts, np.searchsorted(starts, offsets)


def encode_texts(texts: pa.Array | list[str], path: str, pattern: str) -> Iterator[np.ndarray]:
    """Ids of each text (none for a null), in order, a bounded piece at a time."""
    if pattern == BUILT_IN:
        known = word_ids(path)
        for _, _, data, offsets in pieces(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()), WORDS_PIECE):
            starts, first = word_cuts(data, offsets)
            ids, by_word = flat_ids(known.take(known.find(as_binary(data, starts)), 0))
            bounds, ids = by_word[first].tolist(), ids.astype(np.uint32)
            yield from (ids[a:b] for a, b in zip(bounds, bounds[1:]))
        return
    texts = texts.fill_null("").to_pylist() if isinstance(texts, pa.Array) else texts
    tok = encoder(path, pattern)
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= PIECE):
            size += len(texts[hi])
            hi += 1
        for e in tok.encode_batch_fast(texts[lo:hi], add_special_tokens=False):
            yield np.array(e.ids, dtype=np.uint32)
        lo = hi


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids",
           spans: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array of int) appended, and with ``ids``_start / ``ids``_end
    (character offsets) if ``spans``."""
    at = docs.columns.index(text)
    more = [ids, f"{ids}_start", f"{ids}_end"][:3 if spans else 1]
    kind = pa.list_(pa.int32())

    def run(batches):
        for batch in slices(batches):
            found = list(encode_texts(batch.column(at), path, pattern))
            cols = [found]
            if spans:
                both = [char_spans(x, path) for x in found]
                cols += [[s for s, _ in both], [e for _, e in both]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array([x.astype(np.int32) for x in c], kind) for c in cols)],
                names=[*batch.schema.names, *more])

    lists = [StructField(c, ArrayType(IntegerType())) for c in more]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *lists]))


def digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id",
            text: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian 32-bit), decoded_sha256 and n_bytes of
    every row, and the ids if ``with_ids``: encodes, then decodes the ids."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", *(["ids"] if with_ids else [])]

    def run(batches):
        for batch in slices(batches):
            n, a, b, size, ids = [], [], [], [], []
            for x in encode_texts(batch.column(1), path, pattern):
                back = decode(x, path)
                n.append(len(x))
                size.append(len(back))
                if with_ids:
                    ids.append(x.astype(np.int32))
                a.append(hashlib.sha256(x.astype("<u4").tobytes()).hexdigest())
                b.append(hashlib.sha256(back).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()),
                 pa.array(b, pa.string()), pa.array(size, pa.int64()),
                 *([pa.array(ids, pa.list_(pa.int32()))] if with_ids else [])], names=names)

    id_type = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInArrow(
        run, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"
        + (", ids array<int>" if with_ids else ""))
