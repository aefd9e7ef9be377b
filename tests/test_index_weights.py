import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators import index, joins, order, weights

TEXTS = ("aa bb bb", "bb cc", "dd", "")


@pytest.fixture(scope="module")
def built(corpus_of):
    return index.build_index(corpus_of(*TEXTS))


def brute_l2(texts):
    counts = [Counter(t.split()) for t in texts]
    df = Counter(w for c in counts for w in c)
    n = len(texts)
    out = {}
    for d, c in enumerate(counts):
        raw = {w: k * (math.log((1 + n) / (1 + df[w])) + 1) for w, k in c.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(d, w): v / norm for w, v in raw.items()})
    return out


def as_dict(df):
    return {(r["doc_id"], r["term"]): r["w"] for r in df.collect()}


def test_build_index(built, rows_of):
    assert built.n_docs == 4
    assert rows_of(built.postings, "doc_id", "term") == [
        (0, "aa", 1), (0, "bb", 2), (1, "bb", 1), (1, "cc", 1), (2, "dd", 1),
    ]
    assert rows_of(built.stats, "term") == [("aa", 1), ("bb", 2), ("cc", 1), ("dd", 1)]


def test_save_and_load(spark, built, rows_of, tmp_path):
    built.save(str(tmp_path / "index"))
    again = index.Index.load(spark, str(tmp_path / "index"))
    assert again.n_docs == 4
    assert rows_of(again.postings, "doc_id", "term") == rows_of(built.postings, "doc_id", "term")
    assert rows_of(again.stats, "term") == rows_of(built.stats, "term")


def test_inverted_index_blocks(spark, rows_of):
    held = spark.range(0, 10).select(F.lit("the").alias("term"), F.col("id").alias("doc_id"))
    found = rows_of(index.inverted_index(held, ids_per_block=4), "term", "block")
    assert found == [("the", 0, [0, 1, 2, 3]), ("the", 1, [4, 5, 6, 7]), ("the", 2, [8, 9])]


def test_term_lookup(spark, built, rows_of):
    probes = spark.createDataFrame(
        [(0, "bb"), (1, "aa"), (7, "aa"), (2, "dd")], "doc_id bigint, word string"
    )
    assert rows_of(index.term_lookup(built.postings, probes), "doc_id", "word") == [
        (0, "bb", 1), (1, "aa", 0), (2, "dd", 1), (7, "aa", 0),
    ]


def test_tfidf_log10(built):
    assert as_dict(weights.tfidf_log10(built)) == pytest.approx(
        {
            (0, "aa"): math.log10(4), (0, "bb"): 2 * math.log10(2),
            (1, "bb"): math.log10(2), (1, "cc"): math.log10(4), (2, "dd"): math.log10(4),
        }
    )


def test_tfidf_l2(built):
    found = as_dict(weights.tfidf_l2(built))
    assert found == pytest.approx(brute_l2(TEXTS))
    for doc in (0, 1, 2):
        assert sum(w * w for (d, _), w in found.items() if d == doc) == pytest.approx(1)


def test_arrival_by_hand(corpus_of):
    found = as_dict(weights.tfidf_arrival(corpus_of(*TEXTS), tx.tokenize_terms("text")))
    assert found == pytest.approx(
        {
            (0, "aa"): 0.0, (0, "bb"): 0.0, (1, "bb"): 0.0,
            (1, "cc"): math.log10(2), (2, "dd"): math.log10(3),
        }
    )


@pytest.mark.parametrize("scale", [1, 10**14])
def test_arrival_over_many_blocks(spark, scale):
    """Two-level counting against a plain loop, with dense and with sparse ids."""
    dice = random.Random(5)
    texts = {
        (i - 20) * scale: " ".join(dice.choices(["hot", "aa", "bb", "cc"], [9, 3, 2, 1], k=3))
        for i in range(60)
    }
    corpus = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    expected, seen = {}, Counter()
    for n, (doc, text) in enumerate(sorted(texts.items()), start=1):
        counts = Counter(text.split())
        seen.update(counts.keys())
        expected.update({(doc, w): k * math.log10(n / seen[w]) for w, k in counts.items()})
    found = weights.tfidf_arrival(corpus, tx.tokenize_terms("text"), rows_per_block=7)
    assert as_dict(found) == pytest.approx(expected)
    blocks = order.with_blocks(corpus, "doc_id", 7).groupBy("_block").count().collect()
    assert 1 < len(blocks) and max(r["count"] for r in blocks) <= 7


def test_log10_smooth(corpus_of):
    found = as_dict(
        weights.tfidf_log10_smooth(corpus_of(*TEXTS), tx.tokenize_terms("text"), ["bb", "zz"])
    )
    assert found == pytest.approx(
        {
            (0, "bb"): 2 * math.log10(4 / 3), (1, "bb"): math.log10(4 / 3), (2, "bb"): 0.0,
            (3, "bb"): 0.0, **{(d, "zz"): 0.0 for d in range(4)},
        }
    )


def test_document_terms(corpus_of, rows_of):
    found = rows_of(
        weights.document_terms(corpus_of("Dog cat dog the x", "the", ""), ("the",)), "doc_id", "rank"
    )
    assert [r[:3] for r in found] == [(0, 1, "dog"), (0, 2, "cat")]
    assert [r[3] for r in found] == pytest.approx([2 / math.sqrt(5), 1 / math.sqrt(5)])


def test_analysed_words(corpus_of, rows_of):
    found = rows_of(index.analysed_words(corpus_of("dog, Dog The dog the", "")), "term")
    assert found == [(0, "dog", "Dog"), (0, "the", "The")]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one key, a third have none."""
    pairs = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 50}") for i in range(900)]
    rows = spark.createDataFrame(pairs, "doc_id bigint, term string")
    keys = sorted({k for _, k in pairs if k}) + ["unused"]
    table = spark.createDataFrame(
        [(k, i) for i, k in enumerate(keys) if k != "k2"], "term string, v bigint"
    )
    return rows, table


def test_lookup_join_beyond_the_broadcast_limit(skewed, rows_of):
    rows, table = skewed
    plain = rows_of(rows.join(table, "term", "left").select("doc_id", "term", "v"), "doc_id")
    assert rows_of(joins.lookup_join(rows, table, "term"), "doc_id")
    for hot in (2, 5, 10_000):
        found = joins.lookup_join(rows, table, "term", limit=0, hot=hot)
        assert rows_of(found.select("doc_id", "term", "v"), "doc_id") == plain
    counts = rows.groupBy("term").count()
    found = joins.lookup_join(rows, table, "term", counts=counts, count="count", limit=0, hot=3)
    assert rows_of(found.select("doc_id", "term", "v"), "doc_id") == plain


def test_drop_listed(spark, skewed, rows_of):
    rows, _ = skewed
    stop = spark.createDataFrame([("hot",), ("k2",), ("hot",)], "term string")
    left = joins.drop_listed(rows, stop, "term")
    assert left.count() == rows.where("term IS NULL OR term NOT IN ('hot', 'k2')").count()


def test_expanding_join_beyond_the_broadcast_limit(skewed, rows_of):
    rows, table = skewed
    table = table.unionByName(table.withColumn("v", F.col("v") + 1000))
    plain = rows_of(rows.join(table, "term").select("doc_id", "term", "v"), "doc_id", "v")
    for limit, hot in ((1 << 20, 10), (0, 2), (0, 10_000)):
        found = joins.expanding_join(
            rows, table, "term", spread="doc_id", limit=limit, hot=hot, salts=4
        )
        assert rows_of(found.select("doc_id", "term", "v"), "doc_id", "v") == plain


def test_hot_keys_are_few(spark):
    counts = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("n"))
    counts = counts.unionByName(spark.sql("SELECT 'hot' AS k, 500 AS n"))
    assert [r["k"] for r in joins.hot_keys(counts, "k", "n", 10).collect()] == ["hot"]


def test_fits_broadcast(spark):
    table = spark.createDataFrame([("x" * 100, 1)] * 10, "a string, b bigint")
    assert joins.fits_broadcast(table, 2000) and not joins.fits_broadcast(table, 1000)
    assert joins.fits_broadcast(table.limit(0), 0)


def test_document_terms_tokenizes_once(corpus_of):
    found = weights.document_terms(corpus_of("Cannot the cat."), ["the"])
    assert found._jdf.queryExecution().executedPlan().toString().count("(?i:(can(?=not") == 1
