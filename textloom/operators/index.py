"""Postings, term statistics and look-ups."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import (
    first_forms,
    split_words,
    term_counts,
    tokenize_alnum,
    tokenize_terms,
)
from textloom.functions.words import ENGLISH_STOP_WORDS
from textloom.operators.joins import fits_broadcast
from textloom.session import materialize

IDS_PER_BLOCK = 100_000


def term_frequency(corpus: DataFrame, tokens: Column, doc: str = "doc_id") -> DataFrame:
    """Postings ``(doc_id, term, tf)``. One document is one row, so this needs no shuffle."""
    return corpus.select(doc, F.inline(term_counts(tokens)))


def doc_frequency(corpus: DataFrame, tokens: Column) -> DataFrame:
    """``(term, df)``: the number of documents holding each term."""
    return (
        corpus.select(F.explode(F.array_distinct(tokens)).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def posting_frequency(postings: DataFrame) -> DataFrame:
    """``(term, df)`` from postings that hold each (document, term) once."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def analysed_words(
    corpus: DataFrame,
    text: str = "text",
    doc: str = "doc_id",
    stop_words: Iterable[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """``(doc_id, term, shown)``: each distinct content word of a document, next to the
    form it is shown in (its first form that is not lower case, if there is one)."""
    stop_words = tuple(stop_words)
    terms = F.filter(
        F.transform(tokenize_alnum(text, stop_words), lambda word: F.lower(word)),
        lambda word: F.length(word) >= 2,
    )
    return corpus.select(doc, F.inline(first_forms(terms, split_words(text))))


def inverted_index(
    postings: DataFrame,
    term: str = "term",
    doc: str = "doc_id",
    ids_per_block: int = IDS_PER_BLOCK,
) -> DataFrame:
    """``(term, block, doc_ids)``: the ascending ids of the documents holding a term.

    A term held by a third of all documents would not fit one array, so its list is
    cut by id range: a block holds the ids of ``[block * n, (block + 1) * n)`` and
    never more than ``n`` of them. A term's blocks in order make up its whole list.
    """
    return (
        postings.select(F.col(term).alias("term"), F.col(doc).alias("_doc"))
        # Whole numbers all the way: doubles would move ids above 2 ** 53 to a neighbouring block.
        .withColumn("block", F.expr(f"(_doc - pmod(_doc, {ids_per_block}L)) div {ids_per_block}L"))
        .groupBy("term", "block")
        .agg(F.sort_array(F.collect_set("_doc")).alias("doc_ids"))
    )


def term_lookup(postings: DataFrame, probes: DataFrame, term: str = "term") -> DataFrame:
    """``(doc_id, word, found)``: 1 where the probed document holds the probed word."""
    held = postings.select("doc_id", F.col(term).alias("word"), F.lit(1).alias("found"))
    words = probes.select("word").distinct()
    if fits_broadcast(words):
        held = held.join(F.broadcast(words), "word", "left_semi")
    return probes.join(held, ["doc_id", "word"], "left").select(
        "doc_id", "word", F.coalesce("found", F.lit(0)).alias("found")
    )


@dataclass(frozen=True)
class Index:
    """A corpus prepared for weighting and search."""

    postings: DataFrame  # doc_id, term, tf
    stats: DataFrame  # term, df
    n_docs: int
    norms: DataFrame | None = None  # doc_id, norm

    def save(self, path: str) -> None:
        """Write the index below ``path``. Postings are ranged by term, then document, so
        a query reads few row groups and a frequent term is spread over several files."""
        self.postings.repartitionByRange("term", "doc_id").sortWithinPartitions(
            "term", "doc_id"
        ).write.parquet(f"{path}/postings")
        self.stats.repartitionByRange("term").sortWithinPartitions("term").write.parquet(
            f"{path}/stats"
        )
        self.stats.sparkSession.range(1).select(
            F.lit(self.n_docs).cast("long").alias("n_docs")
        ).write.parquet(f"{path}/size")
        if self.norms is not None:
            self.norms.write.parquet(f"{path}/norms")

    @staticmethod
    def load(spark: SparkSession, path: str, norms: bool = False) -> Index:
        """The index saved below ``path``, with its norms if they were saved too."""
        size = spark.read.parquet(f"{path}/size")
        return Index(
            spark.read.parquet(f"{path}/postings"),
            spark.read.parquet(f"{path}/stats"),
            size.first()["n_docs"],
            spark.read.parquet(f"{path}/norms") if norms else None,
        )


def build_index(corpus: DataFrame, tokens: Column | None = None) -> Index:
    """Tokenize ``corpus(doc_id, text)`` once and keep the postings as a written table."""
    if tokens is None:
        tokens = tokenize_terms("text")
    postings = materialize(term_frequency(corpus, tokens), "postings")
    stats = materialize(posting_frequency(postings), "term-stats")
    return Index(postings, stats, corpus.count())
