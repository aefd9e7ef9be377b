"""A training corpus from raw documents: each stage works on what its predecessor kept.

A stage takes ``(spark, docs, sf_dir)`` and returns documents with the columns they came with;
the last one returns the pieces of packed sequences.
"""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import exact_dedup, language_id, ngram_join, packing, suffix_dedup
from textloom.operators.joins import fits_broadcast
from textloom.llm.pretokens import PIECE
from textloom.session import batches_of, materialize

VOCABULARY = "word_bpe_49k.json"


def _few(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if fits_broadcast(table) else table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that may have a learned language. Those without a letter go, and those of which no
    letter is in any training text; where nothing was learned, every row with a letter stays."""
    rows = exact_dedup.placed(docs)
    labelled = rows.where(~language_id.held_out()).select("doc_id", "text", "lang")
    own = rows.select(F.col("_place").alias("doc_id"), "text")
    found = language_id.languages(own, language_id.training_texts(labelled))
    with batches_of(spark, PIECE):
        gone = materialize(found.where("rejected").select(F.col("doc_id").alias("_gone")), "unknown-language")
    return rows.join(_few(gone), rows["_place"] == gone["_gone"], "left_anti").drop("_place")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that with the largest id; a repeated row stays once."""
    return exact_dedup.without_duplicates(docs)


def _own_id(rows: DataFrame) -> DataFrame:
    """Text of each row under its place, as an id may have several texts; null ids stay null."""
    return rows.select(F.when(F.col("doc_id").isNotNull(), F.col("_place")).alias("doc_id"), "text")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that with the smallest id."""
    rows = exact_dedup.placed(docs)
    found = ngram_join.near_duplicates(_own_id(rows)).where("doc_id is not null")
    found = materialize(found.select(F.col("doc_id").alias("_at"), "component_id"), "components")
    several = materialize(found.where("_at != component_id").select("component_id").distinct(), "large-components")
    members = found.join(_few(several), "component_id")
    ids = rows.select(F.col("_place").alias("_at"), F.col("doc_id").alias("_id"))
    members = materialize(ids.join(_few(members), "_at"), "component-members")
    first = materialize(
        members.groupBy("component_id").agg(F.min(F.struct("_id", "_at")).alias("first")).select("component_id", "first._at"),
        "first-members",
    ).withColumnRenamed("_at", "_first")
    gone = materialize(members.join(_few(first), "component_id").where("_at != _first").select("_at"), "near-copies")
    return rows.join(_few(gone), rows["_place"] == gone["_at"], "left_anti").drop("_place")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated strings. Bytes of a character that was cut in two go as
    well; a document of which nothing is left goes. Rows go by their numbers, as an id may have
    several texts or be null."""
    rows = exact_dedup.placed(docs)
    numbered = rows.select(F.col("_place").alias("doc_id"), "text")
    cut = suffix_dedup.without_repeats(numbered, with_text=True)
    with batches_of(spark, PIECE):
        kept = materialize(
            cut.where("n_removed > 0").select(F.col("doc_id").alias("_cut"), F.col("kept").alias("_kept")), "cut-texts"
        )
    text = F.when(F.col("_cut").isNull(), rows["text"]).otherwise(F.col("_kept"))
    new = {"text": text, "n_chars": F.when(F.col("_cut").isNull(), rows["n_chars"]).otherwise(F.length("_kept").cast("long"))}
    return (
        rows.join(_few(kept), rows["_place"] == kept["_cut"], "left")
        .where("_cut is null or _kept != ''")
        .select(*[new[name].alias(name) if name in new else rows[name] for name in docs.columns])
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of sequences of 2048 tokens."""
    with open(public_tokenizers.path(VOCABULARY), "rb") as file:
        make = partial(packing.word_encoder, file.read())
    return packing.packed(docs, make)


STAGES = [
    ("language", known_language),
    ("exact copies", exact_copies),
    ("near copies", near_copies),
    ("repeated passages", repeated_passages),
    ("packing", packed),
]

# Neither learned languages nor tokenizers can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
