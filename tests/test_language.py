import math
from collections import Counter

import pytest

from textloom.operators import language
from textloom.sources import documents as docs

TRAINING = [
    ("de", "das ist ein haus und noch ein haus"),
    ("de", "und das wetter"),
    ("en", "this is a house and a garden"),
    ("fr", "une maison et un jardin ist"),
]
LANGS = ["de", "en", "fr"]


@pytest.fixture(scope="module")
def training(spark):
    return spark.createDataFrame(TRAINING, "lang string, text string")


@pytest.fixture(scope="module")
def profiles(training):
    return language.materialized_profiles(training)


def test_profiles(profiles):
    found = {(r["lang"], r["word"]): r["pc"] for r in profiles.collect()}
    assert found[("de", "ein")] == 2 and found[("de", "das")] == 2
    assert found[("en", "house")] == 1 and ("en", "haus") not in found
    assert language.profile_languages(profiles) == LANGS


def test_word_methods(corpus_of, profiles, rows_of):
    corpus = corpus_of(
        "ein ein ein garden and a house",  # de shares 2, en shares 4
        "ist",                             # de and fr tie: the first wins
        "zzz 123",                         # no overlap: the first language
        "",                                # no words at all
        "wetter garden a",                 # wetter has 6 letters
        "wetter wetter garden",
        "Jardin",
    )
    for limit in (1 << 20, 0):
        found = rows_of(language.word_methods(corpus, profiles, LANGS, limit), "doc_id")
        assert [f for _, f, _ in found] == ["en", "de", "de", "de", "en", "de", "fr"]
        assert [s for _, _, s in found] == ["en", "de", "de", "de", "en", "de", "de"]


def test_order_of_languages_breaks_ties(corpus_of, profiles, rows_of):
    found = language.language_frequent_words(corpus_of("ist", ""), profiles, ["fr", "de", "en"])
    assert rows_of(found, "doc_id") == [(0, "fr"), (1, "fr")]
    short = language.language_short_words(corpus_of("jardin", "et"), profiles, LANGS)
    assert rows_of(short, "doc_id") == [(0, "de"), (1, "fr")]


def brute_model(text):
    def grams(t):
        t = " " + " ".join(t.lower().split()) + " "
        return Counter(t[i : i + 3] for i in range(len(t) - 2))

    model = {lang: Counter() for lang in LANGS}
    for lang, t in TRAINING:
        model[lang].update(grams(t))
    known = set().union(*model.values())
    scores = {
        lang: round(
            sum(
                k * math.log((counts[g] + 1) / (sum(counts.values()) + len(known)))
                for g, k in grams(text).items()
                if g in known
            ),
            6,
        )
        for lang, counts in model.items()
    }
    return max(scores, key=scores.get)


def test_char_model(corpus_of, training, rows_of):
    texts = ["Das Haus", "the house", "un jardin", "zzzqqq", "", "garten", "haus maison a"]
    trigrams = language.materialized_trigrams(training)
    for limit in (1 << 20, 0):
        found = language.language_char_model(corpus_of(*texts), trigrams, LANGS, limit)
        assert [lang for _, lang in rows_of(found, "doc_id")] == [brute_model(t) for t in texts]


def test_held_out_documents(spark):
    """Profiles from some documents recognise the language of the others."""
    labelled = docs.read_documents(
        spark, "/root/testdata/sf0.001/documents.parquet", ("doc_id", "text", "lang")
    )
    training = labelled.where("doc_id % 5 = 0")
    rest = labelled.where("doc_id % 5 <> 0")
    profiles = language.materialized_profiles(training)
    report = language.language_report(
        rest, profiles, language.materialized_trigrams(training), language.profile_languages(profiles)
    )
    judged = report.join(rest, "doc_id").selectExpr(
        "avg(int(freq_result = lang))", "avg(int(short_result = lang))",
        "avg(int(model_result = lang))", "count(*)",
    ).first()
    assert judged[3] == rest.count()
    assert min(judged[:3]) > 0.95


def test_trigrams_are_counted_inside_the_row(spark):
    texts = [(1, "Aa  aa\naa"), (2, None), (3, ""), (4, "x\U0001F600\x00"), (1, "b")]
    corpus = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = sorted(((r["key"], r["word"], r["n"]) for r in language.trigram_counts(corpus, "doc_id").collect()), key=str)
    want = []
    for doc, text in texts:
        spaced = "" if text is None else f" {' '.join(text.lower().split())} "
        counts = Counter(spaced[i : i + 3] for i in range(len(spaced) - 2))
        want += [(doc, word, n) for word, n in counts.items()] or [(doc, None, 0)]
    assert found == sorted(want, key=str)
    merged = language.trigram_counts(corpus, "doc_id", merged=True).where("word IS NOT NULL").groupBy("key", "word").sum("n")
    summed = Counter()
    for doc, word, n in want:
        summed[doc, word] += n
    assert {(r[0], r[1]): r[2] for r in merged.collect()} == {at: n for at, n in summed.items() if at[1] is not None}
