import math
import random

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators import boolean, evaluate, index, search, weights

TEXTS = (
    "http://a\n First title \nred fox red hen",
    "blue fox",
    "green hen\nsecond",
    "",
    "blue fox",
)


@pytest.fixture(scope="module")
def corpus(corpus_of):
    return corpus_of(*TEXTS)


@pytest.fixture(scope="module")
def built(corpus):
    return index.build_index(corpus)


def test_own_text_scores_one_and_ties_go_by_document(built, rows_of):
    found = rows_of(search.ranked_search(built, "blue fox"))
    assert found[:2] == [(1, 1.0), (4, 1.0)]
    assert [d for d, _ in found] == [1, 4, 0]
    assert all(0 < p <= 1 for _, p in found)


def test_by_hand(built):
    n, df = 5, {"red": 1, "fox": 3, "hen": 2, "http": 1, "first": 1, "title": 1}
    idf = {w: math.log((1 + n) / (1 + k)) + 1 for w, k in df.items()}
    tf = {"http": 1, "first": 1, "title": 1, "red": 2, "fox": 1, "hen": 1}
    vector = {w: k * idf[w] for w, k in tf.items()}
    query = {"red": idf["red"], "hen": idf["hen"]}
    dot = sum(vector[w] * query[w] for w in query)
    cosine = dot / math.hypot(*vector.values()) / math.hypot(*query.values())
    found = dict(tuple(r) for r in search.ranked_search(built, "red unknown Hen x").collect())
    assert found[0] == pytest.approx(cosine, abs=1e-8)


def test_saved_index_with_norms(spark, built, rows_of, tmp_path):
    weights.with_norms(built).save(str(tmp_path / "index"))
    again = index.Index.load(spark, str(tmp_path / "index"), norms=True)
    for query in ("blue fox", "hen title"):
        assert rows_of(search.ranked_search(again, query)) == rows_of(
            search.ranked_search(built, query)
        )


def test_nothing_to_find(built):
    for query in ("", "zz yy", "a ! b"):
        assert search.ranked_search(built, query).count() == 0


def test_results_have_titles(built, corpus, rows_of):
    found = rows_of(search.search_results(built, corpus, "fox hen"))
    assert {(d, t) for d, t, _ in found} == {(0, "First title"), (1, ""), (2, "second"), (4, "")}
    assert all(p == round(p, 4) for _, _, p in found)
    assert [p for _, _, p in found] == sorted((p for _, _, p in found), reverse=True)


def test_top_k_equals_single_searches_on_both_paths(spark, corpus_of, rows_of):
    dice = random.Random(3)
    words = ["hot"] * 30 + [f"w{i}" for i in range(12)]
    corpus = corpus_of(*[" ".join(dice.choices(words, k=8)) for _ in range(60)])
    built = index.build_index(corpus)
    texts = [" ".join(dice.choices(words, k=4)) for _ in range(6)]
    queries = spark.createDataFrame(list(enumerate(texts)), "qid bigint, text string")
    expected = [
        (qid, rank, *row)
        for qid, text in enumerate(texts)
        for rank, row in enumerate(rows_of(search.ranked_search(built, text).limit(7)), start=1)
    ]
    assert rows_of(search.search_top_k(built, queries, 7), "qid", "rank") == expected
    assert rows_of(search.search_top_k(built, queries, 7, limit=0), "qid", "rank") == expected


def test_boolean_search(corpus, rows_of):
    def matches(predicate):
        found = boolean.boolean_search(corpus, tx.tokenize_terms("text"), predicate)
        return [doc for doc, rsv in rows_of(found, "doc_id") if rsv == 1]

    has = boolean.has
    fox, hen = has("fox"), has("hen")
    assert matches(fox & hen) == [0]
    assert matches(fox | hen) == [0, 1, 2, 4]
    assert matches(~fox) == [2, 3]
    assert matches((fox & ~has("blue")) | has("green")) == [0, 2]
    assert matches(has("absent")) == []
    assert matches(None) == [0, 1, 2, 3, 4]


def test_boolean_batch(spark, corpus, rows_of):
    clauses = spark.createDataFrame(
        [
            (1, 1, "fox", False), (1, 1, "blue", True), (1, 2, "green", False),
            (2, 1, "fox", True), (2, 1, "absent", True),
            (3, 1, "absent", False),
            (4, 1, "fox", False), (4, 2, "blue", False), (4, 2, "blue", False),
            (5, 1, None, None),
        ],
        "qid bigint, clause int, term string, negated boolean",
    )
    postings = corpus.select(
        "doc_id", F.explode(F.array_distinct(tx.tokenize_terms("text"))).alias("term")
    )
    expected = {1: [0, 2], 2: [2, 3], 4: [0, 1, 4], 5: [0, 1, 2, 3, 4]}
    for limit in (1 << 20, 0):
        found = boolean.boolean_search_batch(corpus, postings, clauses, limit)
        assert rows_of(found, "qid", "doc_id") == [
            (q, d) for q, docs in expected.items() for d in docs
        ]


def test_boolean_batch_of_any_ids(spark, rows_of):
    """Negative ids, ids at both ends of a long, on either side of a word, repeated and null."""
    ids = [-(2**63), 2**63 - 1, -1, 0, 63, 64, -64, -65, 2**40 + 7, 5, 5, None]
    dice = random.Random(7)
    held = [(i, {t for t in "abcd" if dice.random() < 0.6}) for i in ids]
    corpus = spark.createDataFrame([(i, " ".join(sorted(ts))) for i, ts in held], "doc_id bigint, text string")
    postings = spark.createDataFrame([(i, t) for i, ts in held for t in sorted(ts)], "doc_id bigint, term string")
    queries = {
        1: [[("a", False), ("b", True)]], 2: [[("a", True)]], 3: [[("a", False), ("b", False), ("c", False)], [("d", True)]],
        4: [[("a", True), ("b", True), ("zz", True)], [("c", False), ("c", True)]], 5: [[("zz", False)]], 6: [[(None, None)]],
    }
    clauses = spark.createDataFrame(
        [(q, n, t, neg) for q, cs in queries.items() for n, c in enumerate(cs) for t, neg in c],
        "qid bigint, clause int, term string, negated boolean",
    )
    terms = {}
    for i, ts in held:
        terms.setdefault(i, set()).update(ts)
    expected = sorted(
        (q, i)
        for q, cs in queries.items()
        for i, ts in terms.items()
        if i is not None and any(all(t is None or (t in ts) != neg for t, neg in c) for c in cs)
    )
    for limit in (1 << 20, 0):
        assert rows_of(boolean.boolean_search_batch(corpus, postings, clauses, limit), "qid", "doc_id") == expected


def test_bitmaps_pack_before_the_shuffle(spark):
    """A term of all documents moves a word for 64 of them."""
    postings = spark.range(10_000).selectExpr("id AS doc_id", "'all' AS term")
    words = boolean.bitmaps(postings, "term")
    assert words.count() == 157
    assert words.agg(F.sum(F.bit_count("bits"))).first()[0] == 10_000
    assert boolean.members(words).agg(F.count_distinct("doc_id"), F.max("doc_id")).first()[:] == (10_000, 9_999)


@pytest.fixture(scope="module")
def counts(spark):
    queries = spark.createDataFrame([(1,), (2,), (3,), (4,)], "qid bigint")
    pairs = "qid bigint, doc_id bigint"
    retrieved = spark.createDataFrame([(1, 0), (1, 1), (1, 1), (3, 5)], pairs)
    judged = spark.createDataFrame([(1, 1), (1, 2), (2, 0), (3, 5)], pairs)
    return evaluate.confusion_counts(queries, retrieved, judged, 10)


def test_confusion_counts(counts, rows_of):
    assert rows_of(counts, "qid") == [
        (1, 1, 1, 1, 7), (2, 0, 0, 1, 9), (3, 1, 0, 0, 9), (4, 0, 0, 0, 10),
    ]


def test_metrics(counts, rows_of):
    expected = {
        1: (0.5, 0.5, 0.8, 0.2, 0.5), 2: (0, 0, 0.9, 0.1, 0), 3: (1, 1, 1, 0, 1),
        4: (0, 0, 1, 0, 0),
    }
    found = rows_of(evaluate.query_metrics(counts), "qid")
    for qid, *values in found:
        assert values == pytest.approx(expected[qid])
    macro = rows_of(evaluate.macro_average(counts))[0]
    assert macro == pytest.approx([sum(v) / 4 for v in zip(*expected.values())])
    # Means are a = 2/4, b = 1/4, c = 2/4, d = 35/4.
    micro = rows_of(evaluate.micro_average(counts))[0]
    assert micro == pytest.approx([2 / 4, 2 / 3, 37 / 40, 3 / 40, 4 / 7])


def test_macro_is_micro_for_one_query(counts, rows_of):
    one = counts.where("qid = 1")
    macro, micro = evaluate.macro_average(one), evaluate.micro_average(one)
    assert rows_of(macro)[0] == pytest.approx(rows_of(micro)[0])


def test_no_documents_at_all(spark, rows_of):
    empty = spark.createDataFrame([], "qid bigint, doc_id bigint")
    queries = spark.createDataFrame([(1,)], "qid bigint")
    none = evaluate.confusion_counts(queries, empty, empty, 0)
    assert rows_of(evaluate.query_metrics(none)) == [(1, 0.0, 0.0, 0.0, 0.0, 0.0)]


def test_tasks_follow_the_pairs(spark):
    vectors = spark.createDataFrame([(1, "a", 1.0, 700), (2, "a", 1.0, 700), (2, "b", 0.5, 100)], "qid bigint, term string, qw double, df bigint")
    assert search._pair_tasks(vectors, pairs_per_task=10) == 150
    assert search._pair_tasks(vectors.where("false")) >= 1
