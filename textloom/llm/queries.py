"""The operators of this subpackage bound to the given tables, with production parameters."""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import functions as F

from textloom.llm import (
    block_join,
    bpe,
    exact_dedup,
    hard_negatives,
    language_id,
    license_scan,
    merkle_manifest,
    ngram_join,
    packing,
    suffix_dedup,
    token_count,
    topk_search,
    url_filter,
)
from textloom.llm.url_filter import Rule

TOKEN_LIMIT = 512
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def _file(name: str) -> bytes:
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def _documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def op1_ngram_join(spark, sf):
    """Every document with its set's size and the component of near copies it is in."""
    return ngram_join.near_duplicates(_documents(spark, sf))


def op2_bpe_round_trip(spark, sf):
    """Every document encoded and decoded again."""
    ranks = _file("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(_documents(spark, sf), ranks, public_tokenizers.PATTERN)


def op3_language_id(spark, sf):
    """Every document's predicted language, learned from the documents that are not held out."""
    docs = _documents(spark, sf)
    training = language_id.training_texts(docs.where(~language_id.held_out()).select("doc_id", "text", "lang"))
    predicted = language_id.languages(docs, training)
    return predicted.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op4_license_scan(spark, sf):
    """Every license notice that a document holds at least three quarters of."""
    return license_scan.scan(_documents(spark, sf))


def op5_top_k_search(spark, sf):
    """The 20 best candidates of every query vector."""
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    return topk_search.top_k(vectors, F.col("vec_id") % 20 == 0)


def op6_packing(spark, sf):
    """Every document's pieces in sequences of 2048 tokens."""
    make = partial(packing.word_encoder, _file("word_bpe_49k.json"))
    return packing.packed(_documents(spark, sf), make).drop("ids")


def op7_exact_dedup(spark, sf):
    """Every document with the row of its text that stays."""
    return exact_dedup.exact_duplicates(_documents(spark, sf))


def op8_suffix_dedup(spark, sf):
    """Every document's bytes that are part of a repeated string, counted and cut out."""
    return suffix_dedup.without_repeats(_documents(spark, sf))


def op9_url_filter(spark, sf):
    """Every page's rule and verdict."""
    return url_filter.url_verdicts(spark.read.parquet(f"{sf}/pages.parquet"), RULES)


def op10_token_count(spark, sf):
    """Every document's tokens, and whether they are too many for one context."""
    return token_count.token_counts(
        _documents(spark, sf), _file("byte_bpe_50k.json"), public_tokenizers.PATTERN, TOKEN_LIMIT
    )


def op11_block_join(spark, sf):
    """The 20 nearest vectors of every query vector."""
    return block_join.nearest(spark.read.parquet(f"{sf}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op12_hard_negatives(spark, sf):
    """Every anchor's positives with their hard negatives, some labels moved on by one."""
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_merkle_manifest(spark, sf):
    """Every document's leaf, roots and proof, and whether the text as tampered with still leads to the root."""
    proved = merkle_manifest.manifest(_documents(spark, sf), merkle_manifest.without_line_feeds())
    return merkle_manifest.checked(proved)


QUERIES = {
    query.__name__: query
    for query in (
        op1_ngram_join, op2_bpe_round_trip, op3_language_id, op4_license_scan, op5_top_k_search,
        op6_packing, op7_exact_dedup, op8_suffix_dedup, op9_url_filter, op10_token_count,
        op11_block_join, op12_hard_negatives, op13_merkle_manifest,
    )
}
