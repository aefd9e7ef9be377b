"""Cosine-ranked search over an index, for one query or a whole table of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from textloom.functions.text import line, tokenize_terms
from textloom.operators.index import Index, term_frequency
from textloom.operators.joins import (
    BROADCAST_BYTES,
    expanding_join,
    fits_broadcast,
    lookup_join,
)
from textloom.operators.weights import document_norms, smooth_idf
from textloom.session import materialize

# Sums of doubles depend on the order of addition in their last digits; scores that
# agree in this many decimals count as equal and are ordered by document.
SCORE_DIGITS = 9
PAIRS_PER_TASK = 2_000_000  # pairs of a query's term and a posting that one task sums


def query_vectors(
    index: Index, queries: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``(qid, term, qw, df)``: unit vectors of ``queries(qid, text)``.

    Terms outside the vocabulary of the index are ignored.
    """
    terms = term_frequency(queries, tokenize_terms("text"), doc="qid")
    if fits_broadcast(terms, limit):
        known = index.stats.join(F.broadcast(terms), "term")
    else:
        known = lookup_join(terms, index.stats, "term", limit=limit).where("df IS NOT NULL")
    weighted = known.select(
        "qid", "term", "df", (F.col("tf") * smooth_idf(index.n_docs, F.col("df"))).alias("_raw")
    )
    length = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy("qid")))
    return weighted.select("qid", "term", (F.col("_raw") / length).alias("qw"), "df")


def _pair_tasks(vectors: DataFrame, pairs_per_task: int = PAIRS_PER_TASK) -> int:
    pairs = vectors.agg(F.sum("df")).first()[0] or 0
    return max(vectors.sparkSession.sparkContext.defaultParallelism, -(-pairs // pairs_per_task))


def similarities(index: Index, queries: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``(qid, doc_id, probability)``: cosine of query and document, where above 0.

    Only postings of query terms are moved, once, by document, to meet the document's
    norm. Then the pairs of query and document are formed and summed in place, over as many tasks
    as their number, known from the document frequencies, asks for. Query tables too large to broadcast meet the postings in a join salted for frequent terms.
    """
    vectors = materialize(query_vectors(index, queries, limit), "query-vectors")
    small = fits_broadcast(vectors, limit)
    terms = vectors.select("term", "df").distinct()
    norms = document_norms(index) if index.norms is None else index.norms
    if small:
        held = index.postings.join(F.broadcast(terms), "term", "left_semi")
    else:
        held = lookup_join(
            index.postings, terms, "term", counts=index.stats, count="df", limit=limit
        ).where("df IS NOT NULL")
    held = (
        held.repartition(_pair_tasks(vectors), "doc_id")
        .join(norms, "doc_id")
        .select("doc_id", "term", (F.col("tf") / F.col("norm")).alias("_part"))
    )
    # Both sides of the product carry the idf: the query in qw, the document through this.
    idf = smooth_idf(index.n_docs, F.col("df"))
    weights = vectors.select("qid", "term", (F.col("qw") * idf).alias("_pair"))
    if small:
        pairs = held.join(F.broadcast(weights), "term")
    else:
        pairs = expanding_join(
            held, weights, "term", spread="doc_id", counts=terms, count="df", limit=limit
        )
    return (
        pairs.groupBy("doc_id", "qid")
        .agg(
            F.round(F.sum(F.col("_part") * F.col("_pair")), SCORE_DIGITS).alias("probability")
        )
        .where(F.col("probability") > 0)
        .select("qid", "doc_id", "probability")
    )


def search_top_k(
    index: Index, queries: DataFrame, k: int = 10, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``(qid, rank, doc_id, probability)``: the ``k`` best documents of every query."""
    best = Window.partitionBy("qid").orderBy(F.desc("probability"), "doc_id")
    return (
        similarities(index, queries, limit)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("qid", "rank", "doc_id", "probability")
    )


def _single(index: Index, query: str) -> DataFrame:
    spark = index.postings.sparkSession
    return spark.range(1).select(F.col("id").alias("qid"), F.lit(query).alias("text"))


def ranked_search(index: Index, query: str) -> DataFrame:
    """``(doc_id, probability)`` of every document akin to ``query``, best first.

    An empty query, or one of unknown words only, finds nothing.
    """
    return (
        similarities(index, _single(index, query))
        .select("doc_id", "probability")
        .orderBy(F.desc("probability"), "doc_id")
    )


def search_results(index: Index, corpus: DataFrame, query: str, digits: int = 4) -> DataFrame:
    """``(doc_id, title, probability)``: results labelled by the second line of the document.

    A document of one line has an empty title.
    """
    titles = corpus.select("doc_id", line("text", 2).alias("title"))
    return (
        similarities(index, _single(index, query))
        .join(titles, "doc_id")
        .orderBy(F.desc("probability"), "doc_id")
        .select("doc_id", "title", F.round("probability", digits).alias("probability"))
    )
