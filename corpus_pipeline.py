"""A training corpus from ``documents``: five stages, each on all rows that the one before kept.

Language identification drops what no learned language is near to; the quality classifier drops
what it scores below 0.3; near-duplicate classes keep one document; the mix repeats or drops
documents towards its sources' targets; byte-level BPE encodes what is left.  All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from pricelake.llm import bpe, langid, minhash, mixing, quality
from pricelake.llm.common import ship, stored, table
from pricelake.llm.queries import VOCABULARY


def known_language(spark, docs, sf_dir):
    """Documents in a language learned from the labelled ones."""
    ship(spark)
    return langid.keep_known(docs, langid.learn(docs))


def good_quality(spark, docs, sf_dir):
    """Documents of good quality, learned from ``labels``."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return quality.keep_good(docs, model)


def one_of_each(spark, docs, sf_dir):
    """One document of each near-duplicate class (5-word shingles, similarity 0.8)."""
    ship(spark)
    return minhash.keep_one(docs)


def mixed(spark, docs, sf_dir):
    """Documents as often as the mix of their sources takes them."""
    return mixing.mix(docs)


def encoded(spark, docs, sf_dir):
    """Token ids of every document, with digests of the ids and of the bytes they decode to."""
    ship(spark)
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("language_id", known_language),
    ("quality", good_quality),
    ("near_dedup", one_of_each),
    ("mix", mixed),
    ("byte_bpe", encoded),
]

#: Hashing, learned models and BPE have no SQL form; tests/llm compares the stages with plain code.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
