"""Term weights. The formulas differ on purpose; each has its own function.

``index`` holds postings, document frequencies and the number of documents N.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from textloom.functions.text import bind, first_forms, split_words, term_counts, tokenize_alnum
from textloom.operators.index import Index
from textloom.operators.joins import fits_broadcast, lookup_join
from textloom.operators.order import ROWS_PER_BLOCK, running_position, with_blocks
from textloom.session import materialize


def with_document_frequency(index: Index) -> DataFrame:
    return lookup_join(index.postings, index.stats, "term", counts=index.stats, count="df")


def smooth_idf(n_docs: int, df: Column) -> Column:
    return F.log(F.lit(1.0 + n_docs) / (df + 1)) + F.lit(1.0)


def tfidf_log10(index: Index) -> DataFrame:
    """tf * log10(N / df)."""
    return with_document_frequency(index).select(
        "doc_id",
        "term",
        (F.col("tf") * F.log10(F.lit(float(index.n_docs)) / F.col("df"))).alias("w"),
    )


def tfidf_arrival(
    corpus: DataFrame,
    tokens: Column,
    rows_per_block: int = ROWS_PER_BLOCK,
    seen: DataFrame | None = None,
    n_seen: int = 0,
) -> DataFrame:
    """tf * log10(N / df), N and df counting only the documents that came no later.

    Documents arrive by ascending ``doc_id``, after ``n_seen`` others of which ``seen(term, df)`` are
    the document frequencies. Both running counts are two-level.
    """
    placed = running_position(
        with_blocks(corpus.select("doc_id"), "doc_id", rows_per_block), [], "doc_id", "n"
    )
    placed = materialize(placed, "places")
    if fits_broadcast(placed):
        placed = F.broadcast(placed)
    # Terms are counted first, so texts are not shuffled even where the places do not fit.
    counts = materialize(corpus.select("doc_id", F.inline(term_counts(tokens))), "arrived-terms")
    arrived = counts.join(placed, "doc_id").select("doc_id", "n", "_block", "term", "tf")
    counted = running_position(materialize(arrived, "arrivals"), ["term"], "doc_id", "df")
    if seen is not None:
        before = seen.select("term", F.col("df").alias("_before"))
        counted = lookup_join(counted, before, "term").withColumns(
            {"df": F.col("df") + F.coalesce("_before", F.lit(0)), "n": F.col("n") + n_seen}
        )
    return counted.select(
        "doc_id",
        "term",
        (F.col("tf") * F.log10(F.col("n") / F.col("df"))).alias("w"),
    )


def tfidf_log10_smooth(corpus: DataFrame, tokens: Column, terms: Sequence[str]) -> DataFrame:
    """tf * log10(N / (1 + df)) of each given term in each document, 0 where it is absent."""

    def pair(term: str) -> Column:
        occurrences = F.size(F.filter("_found", lambda token: token == F.lit(term)))
        return F.struct(F.lit(term).alias("term"), occurrences.cast("long").alias("tf"))

    wanted = F.filter(tokens, lambda token: token.isin(list(terms)))
    counts = materialize(
        corpus.select("doc_id", wanted.alias("_found")).select(
            "doc_id", F.inline(F.array(*[pair(term) for term in terms]))
        ),
        "given-terms",
    )
    # One row per given term, so the broadcast is as long as the argument.
    stats = counts.groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("tf") > 0).alias("df")
    )
    return counts.join(F.broadcast(stats), "term").select(
        "doc_id",
        "term",
        (F.col("tf") * F.log10(F.col("n") / (F.col("df") + 1))).alias("w"),
    )


def document_norms(index: Index) -> DataFrame:
    """``(doc_id, norm)``: the length of each document's weighted vector."""
    raw = F.col("tf") * smooth_idf(index.n_docs, F.col("df"))
    return (
        with_document_frequency(index)
        .groupBy("doc_id")
        .agg(F.sqrt(F.sum(raw * raw)).alias("norm"))
    )


def with_norms(index: Index) -> Index:
    """The index with its vector lengths written down, for many searches."""
    return replace(index, norms=materialize(document_norms(index), "norms"))


def tfidf_l2(index: Index) -> DataFrame:
    """tf * (ln((1 + N) / (1 + df)) + 1), each document scaled to length 1."""
    weighted = with_document_frequency(index).select(
        "doc_id",
        "term",
        (F.col("tf") * smooth_idf(index.n_docs, F.col("df"))).alias("_raw"),
    )
    document = Window.partitionBy("doc_id")
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(document))
    return weighted.select("doc_id", "term", (F.col("_raw") / norm).alias("w"))


def document_terms(corpus: DataFrame, stop_words: Sequence[str], text: str = "text") -> DataFrame:
    """``(doc_id, rank, term, w, shown)``: the content terms of each document, heaviest first,
    and the form each is shown in.

    With a single document every idf is 1, so the weight is tf over the document's
    length; ties are alphabetical. All of it happens inside the document's row.
    """
    terms = F.filter(
        F.transform(tokenize_alnum(text, stop_words), lambda word: F.lower(word)),
        lambda word: F.length(word) >= 2,
    )

    # Both are sorted by term and hold each one once, so they go together place by place.
    counted = bind(
        terms,
        lambda found: F.struct(
            term_counts(found).alias("counts"), first_forms(found, split_words(text)).alias("forms")
        ),
    )

    def by_weight(row: Column) -> Column:
        squares = F.aggregate(
            row["counts"], F.lit(0).cast("long"), lambda total, c: total + c["tf"] * c["tf"]
        )
        return bind(
            F.sqrt(squares.cast("double")),
            lambda length: F.sort_array(
                F.transform(
                    row["counts"],
                    lambda c, i: F.struct(
                        (-c["tf"]).alias("minus"),
                        c["term"].alias("term"),
                        (c["tf"] / length).alias("w"),
                        F.get(row["forms"], i)["shown"].alias("shown"),
                    ),
                )
            ),
        )

    return corpus.select(
        "doc_id", F.posexplode(bind(counted, by_weight)).alias("_at", "_entry")
    ).select(
        "doc_id",
        (F.col("_at") + 1).alias("rank"),
        F.col("_entry.term").alias("term"),
        F.col("_entry.w").alias("w"),
        F.col("_entry.shown").alias("shown"),
    )
