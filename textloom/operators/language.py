"""Language identification by frequent words, short words and character trigrams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.text import normalize_letters, spaced_letters, term_counts
from textloom.operators.joins import BROADCAST_BYTES, lookup_join
from textloom.session import materialize

# Fixed value: the longest word the short-word method looks at.
MAX_LANGUAGES = 500
SHORT_WORD = 5
# Scores equal in this many decimals are a tie, won by the language named first.
SCORE_DIGITS = 6
CHARACTERS_PER_BATCH = 4_000_000  # of text whose trigrams are counted before they are handed on


def language_profiles(
    training: DataFrame, tokens: Column | None = None, lang: str = "lang"
) -> DataFrame:
    """``(lang, word, pc)``: how often each word occurs in the texts of each language."""
    if tokens is None:
        tokens = normalize_letters("text")
    return (
        training.select(F.col(lang).alias("lang"), F.explode(tokens).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("pc"))
    )


def _trigram_rows(batches: Iterable, merged: bool) -> Iterator:
    """Each row's key with its distinct trigrams and their number; a null one where there is none.
    ``merged``: rows of a key that are at hand together are counted as one."""
    import numpy as np
    import pyarrow as pa

    apart = np.array([0x1FFFFF])  # behind every text; no character

    def rows(batch: pa.RecordBatch, texts: list[str | None], at: int) -> pa.RecordBatch:
        words, numbers, lengths, groups = [], [], [], {}
        for place, text in enumerate(texts, at):
            _, held = groups.setdefault(batch.column(0)[place].as_py() if merged else place, (place, []))
            held += np.frombuffer((text or "").encode("utf-32-le"), "<u4").astype(np.int64), apart
        for _, held in groups.values():
            codes = np.concatenate(held)
            grams = codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:]
            whole = (codes[:-2] != apart) & (codes[1:-1] != apart) & (codes[2:] != apart)
            grams, n = np.unique(grams[whole], return_counts=True)
            letters = np.stack([grams >> 42, grams >> 21 & 0x1FFFFF, grams & 0x1FFFFF], 1)
            line = letters.astype("<u4").tobytes().decode("utf-32-le")
            words += [line[i : i + 3] for i in range(0, len(line), 3)] or [None]
            numbers.append(n if n.size else np.zeros(1, np.int64))
            lengths.append(max(n.size, 1))
        key = batch.column(0).take(pa.array(np.repeat([place for place, _ in groups.values()], lengths)))
        return pa.RecordBatch.from_arrays(
            [key, pa.array(words, pa.string()), pa.array(np.concatenate(numbers), pa.int64())], ["key", "word", "n"]
        )

    for batch in batches:
        texts, size, at = [], 0, 0
        for end, text in enumerate(batch.column(1), 1):
            texts.append(text.as_py())
            size += len(texts[-1] or "")
            if size > CHARACTERS_PER_BATCH or end == batch.num_rows:
                yield rows(batch, texts, at)
                texts, size, at = [], 0, end


def trigram_counts(corpus: DataFrame, key: str, text: str = "text", merged: bool = False) -> DataFrame:
    """``(key, word, n)``: the distinct character trigrams of each row with their number.

    A row without trigrams keeps its key, with a null word. Counting inside the row makes several times
    fewer rows than unfolding every trigram. With ``merged``, rows of a key may be counted together.
    """
    rows = corpus.select(F.col(key).alias("key"), spaced_letters(text).alias("text"))
    schema = T.StructType(
        [T.StructField("key", rows.schema["key"].dataType), T.StructField("word", T.StringType()), T.StructField("n", T.LongType())]
    )
    return rows.mapInArrow(partial(_trigram_rows, merged=merged), schema)


def trigram_profiles(training: DataFrame, lang: str = "lang") -> DataFrame:
    """``(lang, word, pc)`` over character trigrams."""
    counts = trigram_counts(training, lang, merged=True).where("word IS NOT NULL")
    return counts.groupBy(F.col("key").alias("lang"), "word").agg(F.sum("n").alias("pc"))


def materialized_profiles(training: DataFrame) -> DataFrame:
    """Word profiles as a written table, for use by several methods."""
    return materialize(language_profiles(training), "profiles")


def materialized_trigrams(training: DataFrame) -> DataFrame:
    return materialize(trigram_profiles(training), "trigrams")


def profile_languages(profiles: DataFrame) -> list[str]:
    """The languages of the profiles in alphabetical order, one to ``MAX_LANGUAGES`` of them."""
    found = profiles.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if not found:
        raise ValueError("no labelled text to learn languages from")
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return [row["lang"] for row in found]


def _wide(profiles: DataFrame, langs: Sequence[str], value: Column, prefix: str) -> DataFrame:
    """One row per word with one column per language, so that a join finds all at once."""
    return profiles.groupBy("word").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("lang") == lang, value)), F.lit(0)).alias(f"{prefix}{i}")
            for i, lang in enumerate(langs)
        ]
    )


def _best(langs: Sequence[str], scores: Sequence[Column]) -> Column:
    """The language of the highest score, the first of them on a tie."""
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return reduce(
        lambda choice, pair: F.when(pair[1] == top, F.lit(pair[0])).otherwise(choice),
        list(zip(langs, scores))[::-1],
        F.lit(langs[0]),
    )


def word_methods(
    corpus: DataFrame,
    profiles: DataFrame,
    langs: Sequence[str],
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(doc_id, freq_result, short_result)`` from one pass over the texts.

    A language scores the multiset overlap of text and profile: the sum over words of
    the smaller of both counts. Without any overlap the first language is the answer.
    """
    wide = materialize(_wide(profiles, langs, F.col("pc"), "p"), "word-profiles")
    words = corpus.select(
        "doc_id", F.inline_outer(term_counts(normalize_letters("text"))).alias("word", "tc")
    )
    matched = lookup_join(words, wide, "word", limit=limit)
    shared = [F.coalesce(F.least("tc", f"p{i}"), F.lit(0)) for i in range(len(langs))]
    short = F.length("word") <= SHORT_WORD
    totals = matched.groupBy("doc_id").agg(
        *[F.sum(s).alias(f"f{i}") for i, s in enumerate(shared)],
        *[F.sum(F.when(short, s).otherwise(0)).alias(f"s{i}") for i, s in enumerate(shared)],
    )
    return totals.select(
        "doc_id",
        _best(langs, [F.col(f"f{i}") for i in range(len(langs))]).alias("freq_result"),
        _best(langs, [F.col(f"s{i}") for i in range(len(langs))]).alias("short_result"),
    )


def language_frequent_words(
    corpus: DataFrame, profiles: DataFrame, langs: Sequence[str]
) -> DataFrame:
    return word_methods(corpus, profiles, langs).select(
        "doc_id", F.col("freq_result").alias("lang")
    )


def language_short_words(
    corpus: DataFrame, profiles: DataFrame, langs: Sequence[str]
) -> DataFrame:
    """The same overlap over words of at most five letters."""
    return word_methods(corpus, profiles, langs).select(
        "doc_id", F.col("short_result").alias("lang")
    )


def language_char_model(
    corpus: DataFrame,
    trigrams: DataFrame,
    langs: Sequence[str],
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(doc_id, lang)`` by naive Bayes over character trigrams, add-one smoothed.

    A language scores the sum over the text's known trigrams of ln((c + 1) / (T + V)):
    c is the trigram's count in the language, T the language's total and V the number
    of distinct trigrams. ln(c + 1) is 0 for c = 0, so only matches need be stored.
    """
    totals = {
        row["lang"]: row["total"]
        for row in trigrams.groupBy("lang").agg(F.sum("pc").alias("total")).collect()
    }
    wide = materialize(_wide(trigrams, langs, F.log(F.col("pc") + F.lit(1.0)), "l"), "trigram-model")
    vocabulary = wide.count()
    grams = trigram_counts(corpus, "doc_id").withColumnRenamed("key", "doc_id")
    matched = lookup_join(grams, wide, "word", limit=limit)
    known = F.sum(F.when(F.col("l0").isNotNull(), F.col("n")).otherwise(0))
    sums = matched.groupBy("doc_id").agg(
        known.alias("known"),
        *[
            F.coalesce(F.sum(F.col("n") * F.col(f"l{i}")), F.lit(0.0)).alias(f"l{i}")
            for i in range(len(langs))
        ],
    )
    scores = [
        F.round(
            F.col(f"l{i}")
            - F.col("known") * F.log(F.lit(float(totals.get(lang, 0) + vocabulary))),
            SCORE_DIGITS,
        )
        for i, lang in enumerate(langs)
    ]
    return sums.select("doc_id", _best(langs, scores).alias("lang"))


def language_report(
    corpus: DataFrame, profiles: DataFrame, trigrams: DataFrame, langs: Sequence[str]
) -> DataFrame:
    """``(doc_id, freq_result, short_result, model_result)``: all three answers."""
    model = language_char_model(corpus, trigrams, langs).withColumnRenamed("lang", "model_result")
    return word_methods(corpus, profiles, langs).join(model, "doc_id")
