"""Extractive summaries, keywords and key phrases of every document of a corpus.

All groups here are keyed by document and no larger than one document. The texts are
shuffled once, by ``doc_id``; the aggregations and windows that follow reuse that
partitioning, whatever further columns they group by.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from textloom.functions.text import (
    ngrams,
    normalize_letters,
    numbered,
    remove_stop_words,
    split_sentences,
    tokenize_words,
)
from textloom.functions.words import SUMMARY_STOP_WORDS

SUMMARY_SENTENCES = 10
KEYWORDS = 10
# Weights equal in this many decimals are a tie, won by what comes first in the text.
WEIGHT_DIGITS = 9
# A text unfolds to some forty times its bytes in words, each with its document, sentence and counts.
TEXT_PER_TASK = 4 << 20


def text_tasks(corpus: DataFrame, text: str = "text", bytes_per_task: int = TEXT_PER_TASK) -> int:
    """How many tasks the texts are dealt to: measured, and no fewer than there are cores."""
    size = corpus.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return max(corpus.sparkSession.sparkContext.defaultParallelism, -(-size // bytes_per_task))


def sentence_arrays(corpus: DataFrame, text: str = "text", tasks: int | None = None) -> DataFrame:
    """``(doc_id, sentences)``, partitioned by document; null ids are no documents.

    Joins by document would leave them out on one side only, below the shuffle: without them
    on both, plans that use the texts several times shuffle them once. The number of tasks follows
    the texts (``text_tasks``), so what is unfolded from them fits one task's memory at any size.
    """
    if tasks is None:
        tasks = text_tasks(corpus, text)
    return (
        corpus.select("doc_id", text)
        .where(F.col("doc_id").isNotNull())
        .repartition(tasks, "doc_id")
        .select("doc_id", split_sentences(text).alias("sentences"))
    )


def sentences(corpus: DataFrame, text: str = "text") -> DataFrame:
    """``(doc_id, i, sentence)``, i counting from 0. Needs no shuffle."""
    return corpus.select("doc_id", F.posexplode(split_sentences(text)).alias("i", "sentence"))


def clean_words(sentence: Column, stop_words: Iterable[str] = SUMMARY_STOP_WORDS) -> Column:
    """The words that carry a sentence's term frequencies."""
    return remove_stop_words(normalize_letters(sentence), stop_words)


def clean_ngrams(
    sentence: Column, n: int = 2, stop_words: Iterable[str] = SUMMARY_STOP_WORDS
) -> Column:
    return ngrams(clean_words(sentence, stop_words), n)


def sentence_frequencies(corpus: DataFrame, units: Column, tasks: int | None = None) -> DataFrame:
    """``(doc_id, n_sentences, i, word, tf, place)`` of the units (words or n-grams) that
    ``units`` makes of column ``sentence``; tf is relative to the sentence, ``place``
    orders words by their first occurrence in the document."""
    parts = (
        sentence_arrays(corpus, tasks=tasks)
        .select("doc_id", F.inline(numbered("sentences")).alias("n_sentences", "i", "sentence"))
        .select(
            "doc_id", "n_sentences", "i", F.inline(numbered(units)).alias("total", "at", "word")
        )
    )
    return (
        parts.groupBy("doc_id", "n_sentences", "i", "total", "word")
        .agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("at"))
        .select(
            "doc_id",
            "n_sentences",
            "i",
            "word",
            (F.col("n") / F.col("total")).alias("tf"),
            (F.shiftleft(F.col("i").cast("long"), 32) + F.col("at")).alias("place"),
        )
    )


def sentence_idf(n_sentences: Column, df: Column) -> Column:
    """ln(S / (1 + df)); negative for a word that nearly all sentences hold."""
    return F.log(n_sentences / (F.lit(1.0) + df))


def tfidf_sentence(corpus: DataFrame, units: Column | None = None) -> DataFrame:
    """``(doc_id, i, word, tf, idf)`` with every sentence taken for a document."""
    if units is None:
        units = clean_words(F.col("sentence"))
    holding = F.count(F.lit(1)).over(Window.partitionBy("doc_id", "word"))
    return sentence_frequencies(corpus, units).select(
        "doc_id", "i", "word", "tf", sentence_idf(F.col("n_sentences"), holding).alias("idf")
    )


def tfidf_ngram(corpus: DataFrame, n: int = 2) -> DataFrame:
    return tfidf_sentence(corpus, clean_ngrams(F.col("sentence"), n))


def sentence_weights(corpus: DataFrame, tasks: int | None = None) -> DataFrame:
    """``(doc_id, i, weight)`` of every sentence, those without words included.

    The sum runs over word occurrences in the sentence as it stands, with tf and idf
    of the cleaned sentence (0 for words that cleaning removed), and is scaled
    by the place in the document and within each five sentences.
    """
    sentence = F.col("sentence")
    occurrences = F.concat(
        F.transform(
            clean_words(sentence),
            lambda word: F.struct(word.alias("word"), F.lit(1).alias("c"), F.lit(0).alias("o")),
        ),
        F.transform(
            tokenize_words(sentence),
            lambda word: F.struct(word.alias("word"), F.lit(0).alias("c"), F.lit(1).alias("o")),
        ),
    )
    counted = (
        sentence_arrays(corpus, tasks=tasks)
        .select("doc_id", F.inline(numbered("sentences")).alias("s", "i", "sentence"))
        .select("doc_id", "s", "i", F.inline_outer(occurrences))
        .groupBy("doc_id", "s", "i", "word")
        .agg(F.sum("c").alias("c"), F.sum("o").alias("o"))
    )
    in_document = Window.partitionBy("doc_id", "word")
    idf = sentence_idf(F.col("s"), F.count_if(F.col("c") > 0).over(in_document))
    scored = counted.select(
        "doc_id", "s", "i", "c", (F.col("c") * F.col("o") * idf).alias("part")
    )
    half = F.col("s") / F.lit(2.0)
    place = F.lit(1.0) - F.abs(F.col("i") - half) / half
    paragraph = F.lit(1.0) / (F.lit(1.0) + F.col("i") % 5)
    total = F.when(F.col("total") > 0, F.col("parts") / F.col("total")).otherwise(F.lit(0.0))
    return (
        scored.groupBy("doc_id", "s", "i")
        .agg(F.sum("part").alias("parts"), F.sum("c").alias("total"))
        .select(
            "doc_id",
            "i",
            (F.round(total * place * paragraph, WEIGHT_DIGITS) + F.lit(0.0)).alias("weight"),
        )
    )


def summary_arrays(
    corpus: DataFrame, size: int = SUMMARY_SENTENCES, tasks: int | None = None
) -> DataFrame:
    """``(doc_id, picked, summary)``: indexes and texts of the heaviest sentences in document
    order, empty for a document without sentences."""
    if tasks is None:
        tasks = text_tasks(corpus)
    heaviest = Window.partitionBy("doc_id").orderBy(F.desc("weight"), "i")
    picked = (
        sentence_weights(corpus, tasks)
        .withColumn("_rank", F.row_number().over(heaviest))
        .where(F.col("_rank") <= size)
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_list("i")).alias("picked"))
    )
    return (
        sentence_arrays(corpus, tasks=tasks)
        .join(picked, "doc_id", "left")
        .select(
            "doc_id",
            F.coalesce("picked", F.array().cast("array<int>")).alias("picked"),
            "sentences",
        )
        .select(
            "doc_id",
            "picked",
            F.transform("picked", lambda i: F.get("sentences", i)).alias("summary"),
        )
    )


def summary(corpus: DataFrame, size: int = SUMMARY_SENTENCES) -> DataFrame:
    """``(doc_id, i, sentence)`` of the heaviest sentences of each document."""
    return summary_arrays(corpus, size).select(
        "doc_id",
        F.inline(F.arrays_zip(F.col("picked").alias("i"), F.col("summary").alias("sentence"))),
    )


def keywords(
    corpus: DataFrame, units: Column | None = None, size: int = KEYWORDS, tasks: int | None = None
) -> DataFrame:
    """``(doc_id, rank, word, weight)``: the units with the largest tf * idf over all
    sentences of a document; equal weights rank by first appearance."""
    if units is None:
        units = clean_words(F.col("sentence"))
    weight = F.sum("tf") * sentence_idf(F.col("n_sentences"), F.count(F.lit(1)))
    scored = (
        sentence_frequencies(corpus, units, tasks)
        .groupBy("doc_id", "n_sentences", "word")
        .agg(
            (F.round(weight, WEIGHT_DIGITS) + F.lit(0.0)).alias("weight"),
            F.min("place").alias("place"),
        )
    )
    heaviest = Window.partitionBy("doc_id").orderBy(F.desc("weight"), "place")
    return (
        scored.withColumn("rank", F.row_number().over(heaviest))
        .where(F.col("rank") <= size)
        .select("doc_id", "rank", "word", "weight")
    )


def keyphrases(corpus: DataFrame, n: int = 2, size: int = KEYWORDS) -> DataFrame:
    """Key phrases: the same ranking over n-grams."""
    return keywords(corpus, clean_ngrams(F.col("sentence"), n), size)


def document_analysis(
    corpus: DataFrame, summary_size: int = SUMMARY_SENTENCES, keyword_count: int = KEYWORDS
) -> DataFrame:
    """``(doc_id, summary, keywords)``: summary sentences, and lines ``word --- weight``."""
    tasks = text_tasks(corpus)
    listed = (
        keywords(corpus, size=keyword_count, tasks=tasks)
        .select(
            "doc_id",
            F.struct(
                "rank",
                F.format_string(f"%s --- %.{WEIGHT_DIGITS}f\n", "word", "weight").alias("line"),
            ).alias("entry"),
        )
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_list("entry")).alias("entries"))
        .select("doc_id", F.array_join("entries.line", "").alias("keywords"))
    )
    return (
        summary_arrays(corpus, summary_size, tasks)
        .join(listed, "doc_id", "left")
        .select("doc_id", "summary", F.coalesce("keywords", F.lit("")).alias("keywords"))
    )
