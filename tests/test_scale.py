"""Ids of any kind, and settings that must not be silently missing."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from textloom import session
from textloom.functions import text as tx
from textloom.operators import index, joins, language, order, weights
from textloom.sources.documents import read_folder


def test_blocks_hold_equally_many(spark):
    ids = spark.range(2000).select(F.col("id").alias("doc_id")).union(spark.createDataFrame([(2**62,)], "doc_id bigint"))
    sizes = [row["count"] for row in order.with_blocks(ids, "doc_id", 100).groupBy("_block").count().collect()]
    assert sum(sizes) == 2001
    assert max(sizes) < 400


def test_arrival_on_folder_ids(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"{i}.txt").write_text("red green " + "blue " * i)
    corpus = read_folder(spark, str(tmp_path))
    found = weights.tfidf_arrival(corpus, tx.tokenize_words("text"), rows_per_block=3)
    assert found.where("term = 'red'").count() == 12
    # In a term that all documents hold, df and n are equal on each arrival.
    assert found.where("term = 'red' and w != 0").count() == 0


def test_blocks_of_large_and_negative_ids(spark):
    at = 2**62
    ids = [at - 1, at, at + 1, -1, -100, -101, 5]
    postings = spark.createDataFrame([(i, "x", 1) for i in ids], "doc_id bigint, term string, tf bigint")
    found = {row["block"]: row["doc_ids"] for row in index.inverted_index(postings, ids_per_block=100).collect()}
    want = {}
    for i in sorted(ids):
        want.setdefault(i // 100, []).append(i)
    assert found == want


def test_number_of_documents_is_kept(spark, corpus_of, tmp_path):
    built = index.build_index(corpus_of("", " "))
    built.save(str(tmp_path / "index"))
    assert index.Index.load(spark, str(tmp_path / "index")).n_docs == 2


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    with pytest.raises(ValueError, match="no labelled text"):
        language.profile_languages(language.language_profiles(none))


def test_no_shared_folder_is_an_error():
    class Context:
        master, applicationId = "spark://cluster:7077", "x"

    class Stub:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_path(Stub(), "label")


def test_scratch_tables_are_discarded_and_nothing_else(spark, tmp_path):
    path = session.scratch_path(spark, "passing")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    session.discard(spark, path)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError, match="not a scratch table"):
        session.discard(spark, str(tmp_path))


def test_salts_follow_the_number_of_rows(spark):
    rows = spark.range(60_000).selectExpr("if(id % 3 > 0, 'hot', concat('k', id % 500)) AS k", "id")
    counts = rows.groupBy("k").count()
    heavy = joins.hot_keys(counts, "k", "count", hot=10, salts=2, rows_per_task=1000)
    assert [(r["k"], r["_salts"]) for r in heavy.collect()] == [("hot", 80)]
    dealt = joins.salted(rows, heavy, "k", "id").groupBy("k", "_salt").count()
    assert dealt.agg(F.max("count")).first()[0] <= 1000
