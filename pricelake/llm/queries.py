"""Registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and DuckDB SQL."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from . import align, ann, bloomlm, bpe, filteraudit, langid, minhash, mixing, packing, quality, tokencount, vecdup, warc
from pricelake.session import scratch_path

from .common import bucket_of, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: The first id that the vocabulary leaves free.
END_OF_DOCUMENT = 50256


def op5_nearest(spark, sf_dir):
    """The 20 nearest vectors found of every twentieth one."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op6_token_counts(spark, sf_dir):
    """Tokens of every document, counted in flat token files written from all documents."""
    docs, folder = table(spark, sf_dir, "documents"), scratch_path(spark, "token-files")
    tokencount.write(docs, folder, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, END_OF_DOCUMENT)
    return tokencount.with_ids(tokencount.count(spark, folder, END_OF_DOCUMENT), tokencount.numbered(docs))


def op7_bloom_lm(spark, sf_dir):
    """Add-one and Bloom-filter bigram scores of every document."""
    docs = table(spark, sf_dir, "documents")
    rest = F.coalesce(F.expr(bucket_of("doc_id", 7)), F.lit(0))
    model = bloomlm.learn(docs.where(rest != 2))
    return bloomlm.score(docs, model, rest == 2)


def op8_warc(spark, sf_dir):
    """All pages written as WARC archives and read back."""
    folder = scratch_path(spark, "warc-files")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.digest_report(warc.read_records(spark, folder, strict=True))


def op9_minhash(spark, sf_dir):
    """Near-duplicate classes of all documents: 4-word shingles, similarity 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op10_byte_bpe(spark, sf_dir):
    """Byte-level BPE ids of every document, and the bytes that they decode to."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
                       public_tokenizers.PATTERN)


def op3_mix(spark, sf_dir):
    """Words that a mix of all documents at 150% of their size takes from each."""
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op4_language_id(spark, sf_dir):
    """Language of every document, learned from three quarters of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    rest = F.expr(bucket_of("doc_id", 4))
    model = langid.learn(docs.where(rest != 2))
    return langid.predict(docs, model, F.coalesce(rest == 2, F.lit(False)))


def op1_vector_dups(spark, sf_dir):
    """Links of cosine 0.98 between vectors of a label, and their classes."""
    return vecdup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_quality(spark, sf_dir):
    """Quality of every document, learned from four fifths of the labelled ones."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rest = F.expr(bucket_of("doc_id", 5))
    return quality.classify(docs, quality.learn(docs, labels, rest != 0), F.coalesce(rest == 0, F.lit(False)))


def op11_filter_audit(spark, sf_dir):
    """What five filters remove from every source, in all orders, alone and together."""
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_packing(spark, sf_dir):
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_alignment(spark, sf_dir):
    """Tokens of two tokenizers aligned over every document, and counts of linked pairs."""
    return align.report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    "op1_vector_dups": op1_vector_dups,
    "op2_quality": op2_quality,
    "op3_mix": op3_mix,
    "op4_language_id": op4_language_id,
    "op5_nearest": op5_nearest,
    "op6_token_counts": op6_token_counts,
    "op7_bloom_lm": op7_bloom_lm,
    "op8_warc": op8_warc,
    "op9_minhash": op9_minhash,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_filter_audit": op11_filter_audit,
    "op12_packing": op12_packing,
    "op13_alignment": op13_alignment,
}

SQL: dict[str, str] = {
    "op1_vector_dups": vecdup.SQL,
    "op3_mix": mixing.SQL,
    "op8_warc": warc.SQL,
    "op9_minhash": minhash.SQL,
    "op11_filter_audit": filteraudit.SQL,
}
