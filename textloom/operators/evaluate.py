"""Retrieval quality: confusion counts, per-query metrics, macro and micro averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.metrics import accuracy, error, f_measure, precision, recall

COUNTS = ("a", "b", "c", "d")
METRICS = ("recall", "precision", "accuracy", "error", "f_measure")


def confusion_counts(
    queries: DataFrame, retrieved: DataFrame, judged: DataFrame, n_docs: int
) -> DataFrame:
    """``(qid, a, b, c, d)`` for every query of ``queries(qid)``.

    ``retrieved`` and ``judged`` are pairs ``(qid, doc_id)``; ``n_docs`` is the size of
    the searched collection. Pairs are brought together by query and document, so a
    query with very many documents is spread like any other.
    """
    found = retrieved.select("qid", "doc_id").distinct().withColumn("_found", F.lit(True))
    relevant = judged.select("qid", "doc_id").distinct().withColumn("_relevant", F.lit(True))
    is_found = F.coalesce("_found", F.lit(False))
    is_relevant = F.coalesce("_relevant", F.lit(False))
    counted = (
        found.join(relevant, ["qid", "doc_id"], "full_outer")
        .groupBy("qid")
        .agg(
            F.count_if(is_found & is_relevant).alias("a"),
            F.count_if(is_found & ~is_relevant).alias("b"),
            F.count_if(~is_found & is_relevant).alias("c"),
        )
    )
    whole = queries.select("qid").distinct().join(counted, "qid", "left").na.fill(0, ["a", "b", "c"])
    return whole.withColumn(
        "d", F.lit(n_docs).cast("long") - F.col("a") - F.col("b") - F.col("c")
    )


def metric_columns() -> list[Column]:
    """The five metrics of a row that has columns a, b, c and d."""
    a, b, c, d = (F.col(name) for name in COUNTS)
    p, r = precision(a, b), recall(a, c)
    values = (r, p, accuracy(a, b, c, d), error(a, b, c, d), f_measure(p, r))
    return [value.cast("double").alias(name) for name, value in zip(METRICS, values)]


def query_metrics(counts: DataFrame) -> DataFrame:
    return counts.select("qid", *metric_columns())


def macro_average(counts: DataFrame) -> DataFrame:
    """The mean over queries of each metric."""
    return query_metrics(counts).agg(*[F.avg(name).alias(name) for name in METRICS])


def micro_average(counts: DataFrame) -> DataFrame:
    """The metrics of the mean counts."""
    return counts.agg(*[F.avg(name).alias(name) for name in COUNTS]).select(*metric_columns())
