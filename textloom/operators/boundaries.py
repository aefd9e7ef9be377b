"""Sentence boundaries that know abbreviations, learned from the corpus itself.

After Kiss and Strunk, "Unsupervised Multilingual Sentence Boundary Detection" (2006): a word is an
abbreviation if it ends in a period far more often than chance would have it. The log-likelihood
ratio of that is weighed by the word's length, its inner periods, and how often it stands without
the period. No list is given and none is kept: the corpus is counted once, and what was learned is
a table of a few words that joins the ends of candidate sentences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from textloom.functions.text import DOTTED, SPACE, spaced_pieces, split_words, word_type
from textloom.operators.joins import lookup_join
from textloom.session import materialize

# Fixed values of the paper: the score from which a word is an abbreviation, and how often an
# abbreviation has its period.
THRESHOLD = 0.3
WITH_PERIOD = 0.99
SCORE_DIGITS = 6
LEAST = 1e-12
# The group of LAST_PIECE, found from the end of the text: one step over what stands before it.
FROM_END = rf"(?s)\A(?:.*[{SPACE}])?([^{SPACE}]+)[{SPACE}]*\z"


def ends_dotted(piece: Column) -> Column:
    """Whether just one period ends a piece; most hold none, which is seen without the pattern."""
    return piece.contains(".") & piece.rlike(DOTTED)


def period_counts(corpus: DataFrame, text: str = "text") -> DataFrame:
    """``(word, dotted, plain)``: how often each word stands with and without a period at its end."""
    pieces = corpus.select(F.explode(split_words(text)).alias("piece")).select(
        word_type(F.col("piece")).alias("word"), ends_dotted(F.col("piece")).alias("dot")
    )
    return (
        pieces.where("word != ''")
        .groupBy("word")
        .agg(F.count_if("dot").alias("dotted"), F.count_if(~F.col("dot")).alias("plain"))
    )


def abbreviations(corpus: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(word, dotted, plain, score)`` of the words that are abbreviations, in lower case, without the
    last period. Words without a letter are none."""
    counts = materialize(period_counts(corpus, text), "period-counts")
    total = counts.agg(F.sum("dotted").alias("periods"), F.sum(F.col("dotted") + F.col("plain")).alias("words")).first()
    share = (total["periods"] or 0) / (total["words"] or 1)
    share = min(max(share, LEAST), 1 - LEAST)
    dotted, plain = F.col("dotted"), F.col("plain")
    by_chance = dotted * F.log(F.lit(share)) + plain * F.log(F.lit(1 - share))
    as_abbreviation = dotted * F.log(F.lit(WITH_PERIOD)) + plain * F.log(F.lit(1 - WITH_PERIOD))
    letters = F.length(F.replace("word", F.lit("."), F.lit(""))).cast("double")
    periods = F.length("word") - letters + 1
    ratio = -2 * (by_chance - as_abbreviation)
    score = ratio * F.exp(-letters) * periods * F.pow(letters, -plain.cast("double"))
    return (
        counts.where((dotted > 0) & F.col("word").rlike(r"\p{L}"))
        .withColumn("score", F.round(score, SCORE_DIGITS))
        .where(F.col("score") >= threshold)
        .select("word", "dotted", "plain", "score")
    )


def trained_sentences(corpus: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """``(doc_id, i, sentence)``, i counting from 0: sentences as ``split_sentences`` makes them, but a period
    behind a word of ``known(word, ...)`` does not end one.

    Candidate sentences meet the known words by their last word. Where one follows on another, white
    space between them stays as it was; line feeds are deleted as everywhere. Ids are unique.
    """
    pieces = corpus.select("doc_id", F.posexplode(spaced_pieces(text)).alias("at", "piece"))
    # Pieces without a period need no look at their last word.
    last = F.when(F.col("piece").contains("."), F.regexp_extract("piece", FROM_END, 1))
    pieces = pieces.withColumn("_last", last).withColumn("word", F.when(ends_dotted(F.col("_last")), word_type(F.col("_last"))))
    pieces = pieces.drop("_last")
    met = lookup_join(pieces, known.select("word", F.lit(True).alias("_goes_on")), "word")
    place = Window.partitionBy("doc_id").orderBy("at")
    begins = F.lag("_goes_on").over(place).isNull().cast("int")
    numbered = met.withColumn("_begins", begins).withColumn("i", F.sum("_begins").over(place) - 1)
    joined = numbered.groupBy("doc_id", "i").agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("_pieces"))
    whole = F.regexp_replace(F.array_join("_pieces.piece", ""), rf"[{SPACE}]+\z", "")
    return joined.select(
        "doc_id", F.col("i").cast("int").alias("i"), F.replace(whole, F.lit("\n"), F.lit("")).alias("sentence")
    ).where("sentence != ''")
