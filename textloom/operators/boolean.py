"""Boolean retrieval: a document's status value is 1 where the expression holds, else 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.joins import BROADCAST_BYTES, expanding_join, fits_broadcast
from textloom.session import materialize

# A word of a bitmap holds the documents of so many successive ids: 2 to this power.
WORD_BITS = 6


def has(term: str, terms: str = "terms") -> Column:
    """Whether a document holds ``term``; combine with ``&``, ``|`` and ``~``."""
    return F.array_contains(F.col(terms), term)


def boolean_search(
    corpus: DataFrame, tokens: Column, predicate: Column | None = None
) -> DataFrame:
    """``(doc_id, rsv)`` for every document; without a predicate all documents match.

    Presence is tested inside each document's row: no shuffle, and documents without
    any token take part, as NOT requires.
    """
    holds = F.lit(True) if predicate is None else predicate
    return corpus.select("doc_id", tokens.alias("terms")).select(
        "doc_id", holds.cast("int").alias("rsv")
    )


def bitmaps(rows: DataFrame, *keys: str, doc: str = "doc_id") -> DataFrame:
    """``(*keys, word, bits)``: the documents of each key, 64 successive ids to a word.

    Bits are set before the shuffle, so a term that most documents hold moves a word for 64 of
    them. Ids may be any long: the shift rounds down, so a negative id has a word of its own range.
    Null ids are no documents.
    """
    bit = F.expr(f"shiftleft(1L, CAST({doc} & {(1 << WORD_BITS) - 1} AS INT))")
    return (
        rows.where(F.col(doc).isNotNull())
        .groupBy(*keys, F.shiftright(doc, WORD_BITS).alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
    )


def members(words: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The documents of bitmaps, one row each; other columns are kept."""
    places = F.filter(F.sequence(F.lit(0), F.lit((1 << WORD_BITS) - 1)), lambda i: F.expr("bits").bitwiseAND(_bit(i)) != 0)
    kept = [name for name in words.columns if name not in ("word", "bits")]
    return words.select(*kept, "word", F.explode(places).alias("_at")).select(
        *kept, (F.shiftleft("word", WORD_BITS) + F.col("_at")).alias(doc)
    )


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def boolean_search_batch(
    corpus: DataFrame, postings: DataFrame, clauses: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``(qid, doc_id)`` of all matches of many queries in disjunctive normal form.

    ``clauses(qid, clause, term, negated)`` has one row per literal; a clause holds
    where all its literals do, a query where any of its clauses does. A null term is
    no literal, so a clause with nothing else is true everywhere.

    Postings of the literals' terms become bitmaps before anything is shuffled, and clauses are
    bitwise algebra on their words: AND over literals, negated ones turned round. A clause
    without positive literals starts from the bitmap of the whole corpus. Matches unfold at
    the very end. Repeated documents match once, null ids never.
    """
    literals = clauses.where(F.col("term").isNotNull()).select(
        "qid", "clause", "term", F.coalesce("negated", F.lit(False)).alias("negated")
    )
    literals = materialize(literals.distinct(), "literals")
    needed = clauses.groupBy("qid", "clause").agg(
        F.count_distinct(F.when(~F.coalesce("negated", F.lit(False)), F.col("term"))).alias("needed")
    )
    needed = materialize(needed, "clauses")
    small = fits_broadcast(clauses, limit)
    terms = literals.select("term").distinct()
    held = postings.join(F.broadcast(terms) if small else terms, "term", "left_semi")
    words = materialize(bitmaps(held, "term"), "term-bitmaps")
    if small:
        met = words.join(F.broadcast(literals), "term")
    else:
        met = expanding_join(words, literals, "term", spread="word", limit=limit)
    met = met.select(
        "qid", "clause", "word", "negated", F.when(F.col("negated"), F.bitwise_not("bits")).otherwise(F.col("bits")).alias("bits")
    )
    # Clauses without a positive literal meet every word of the corpus, by a key that all of them share.
    groundless = needed.where("needed = 0").select("qid", "clause", F.lit(0).alias("_all"))
    if not groundless.isEmpty():
        everything = bitmaps(corpus.select("doc_id"))
        everything = materialize(everything.withColumn("_all", F.lit(0)), "corpus-bitmap")
        whole = expanding_join(everything, groundless, "_all", spread="word", limit=limit)
        met = met.unionByName(whole.select("qid", "clause", "word", F.lit(None).cast("boolean").alias("negated"), "bits"))
    ground = F.count_if(~F.col("negated")).alias("_met")
    held = met.groupBy("qid", "clause", "word").agg(
        F.bit_and("bits").alias("bits"), ground, F.count_if(F.col("negated").isNull()).alias("_whole")
    )
    needed = F.broadcast(needed) if fits_broadcast(needed, limit) else needed
    held = held.join(needed, ["qid", "clause"]).where(
        (F.col("_met") == F.col("needed")) & ((F.col("needed") > 0) | (F.col("_whole") > 0))
    )
    return members(held.groupBy("qid", "word").agg(F.bit_or("bits").alias("bits")))
