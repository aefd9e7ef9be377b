"""The registered queries, and each stage of the pipeline against what its operator says."""

import random

import pytest
from pyspark.sql import functions as F

import check
import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from textloom.llm import ngram_join, suffix_dedup
from textloom.llm.oracle import ORACLES
from textloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_ngram_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op2_bpe_round_trip": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op3_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op4_license_scan": {"doc_id": "bigint", "license": "string"},
    "op5_top_k_search": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op6_packing": {
        "doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint",
        "sequence_id": "bigint", "offset": "bigint",
    },
    "op7_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op8_suffix_dedup": {
        "doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"
    },
    "op9_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op10_token_count": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op11_block_join": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op12_hard_negatives": {
        "anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint",
        "negative_score": "bigint",
    },
    "op13_merkle_manifest": {
        "doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string",
        "folded_root": "string", "verified": "boolean",
    },
}


def test_all_are_registered():
    assert set(COLUMNS) == set(QUERIES)
    assert {*QUERIES, "pipeline"} <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns_of_the_contract(spark, name):
    kinds = dict(QUERIES[name](spark, FOLDER).dtypes)
    assert COLUMNS[name].items() <= kinds.items()


@pytest.mark.parametrize("name", list(ORACLES))
def test_twins(spark, name):
    ours = QUERIES[name](spark, FOLDER).toPandas()
    twin = check.twin_connection(FOLDER).execute(ORACLES[name]).df()
    assert check.difference(ours, twin) is None


def test_stages(spark):
    """Each stage does to its own input what its operator says of it."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame(
        [(10**6, None, None, "x", 0), (10**6 + 1, "", "en", "x", 0), (10**6 + 2, "1 2 3", "en", None, None)], docs.schema
    )
    docs = docs.unionByName(odd)
    (_, language), (_, exact), (_, near), (_, passages), (_, packing) = corpus_pipeline.STAGES

    kept = language(spark, docs, FOLDER).cache()
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - docs.where("text is null or not regexp_like(text, '\\\\p{L}')").count()

    once = exact(spark, kept, FOLDER).cache()
    assert once.columns == docs.columns
    assert once.count() == kept.select("text").distinct().count()
    assert once.select("doc_id").subtract(kept.groupBy("text").agg(F.max("doc_id").alias("doc_id")).select("doc_id")).count() == 0

    apart = near(spark, once, FOLDER).cache()
    assert apart.columns == docs.columns
    stays = ngram_join.near_duplicates(once).where("doc_id = component_id").select("doc_id")
    assert sorted(r[0] for r in apart.select("doc_id").collect()) == sorted(r[0] for r in stays.collect())

    cut = passages(spark, apart, FOLDER).cache()
    assert cut.columns == docs.columns
    said = {r["doc_id"]: r for r in suffix_dedup.without_repeats(apart, with_text=True).collect()}
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    before = {r["doc_id"]: r["text"] for r in apart.collect()}
    for i, row in said.items():
        if row["n_removed"] == 0:
            assert texts[i] == before[i]
        else:
            assert texts.get(i, "") == row["kept"]
    # Nothing that is left is repeated where nothing was cut.
    assert set(texts) == {i for i, row in said.items() if row["n_removed"] == 0 or row["kept"]}

    rows = packing(spark, cut, FOLDER).collect()
    assert {row["doc_id"] for row in rows} == set(texts)


def test_language_stage_looks_at_letters_and_rows(spark):
    """A label und is no language, an id may have two texts, and a script that nobody learned goes."""
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    stage = corpus_pipeline.STAGES[0][1]
    rows = [(i, "the cat and the dog sat on the mat", "en") for i in range(1, 21)]
    rows += [(i, "xq zzv kkj wqx vvq jjx", "und") for i in range(21, 41)]
    rows += [(50, "xq zzv kkj", None), (51, "1 2 3", "en"), (51, "the other dog", "en"), (52, "\u4e2d\u6587", None), (None, None, None)]

    def kept(rows):
        given = spark.createDataFrame([(i, text, lang, "x", 1) for i, text, lang in rows], schema)
        return sorted((r["doc_id"], r["text"]) for r in stage(spark, given, FOLDER).collect())

    french = [(i, "les mots qui vont zxq jvk", "fr") for i in range(60, 80)]
    gone = {"1 2 3", "\u4e2d\u6587", None}
    assert kept(rows + french) == sorted((i, text) for i, text, _ in rows + french if text not in gone)
    unlabelled = [(i, text, None) for i, text, _ in rows]
    assert kept(unlabelled) == sorted((i, text) for i, text, _ in rows if text not in ("1 2 3", None))


def test_repeated_rows_stay_once(spark):
    """Rows that come twice, and ids that have several texts, through the whole chain."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    draw = random.Random(9)

    def prose(n):
        return " ".join("".join(draw.choices("abcdefghij", k=7)) for _ in range(n))

    shared, copied = prose(80), prose(200)
    rows = [
        (1, prose(100)), (2, "short one"), (3, prose(30) + shared + prose(25)), (3, shared + " " + prose(40)),
        (4, copied), (5, copied + " end"), (5, prose(90)), (None, prose(70)), (None, "short one"),
    ]
    given = [(i, text, "en", "x", len(text)) for i, text in rows]
    kept = spark.createDataFrame([*given, *given, given[0]], docs.schema).repartition(3)
    seen = {}
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        kept = stage(spark, kept, FOLDER).cache()
        assert kept.columns == docs.columns
        seen[name] = sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect())
    once = sorted((i or 0, text) for i, text in rows[:-1])
    assert seen["exact copies"] == once  # the row without an id has a copy that has one
    apart = [row for row in once if row[1] != copied + " end"]
    assert seen["near copies"] == apart
    cut = sorted((i, text.replace(shared, "")) for i, text in apart)
    assert [i for i, _ in seen["repeated passages"]] == [i for i, _ in cut]
    # A byte on either side may be equal by chance, and goes with the passage.
    for (i, text), (_, want) in zip(seen["repeated passages"], cut):
        assert text == want if i != 3 else len(want) - 2 <= len(text) <= len(want)
    assert all(r["n_chars"] == len(r["text"]) for r in kept.collect())
    packing = corpus_pipeline.STAGES[-1][1](spark, kept, FOLDER)
    assert {r["doc_id"] for r in packing.collect()} >= {1, 2, 3, 4, 5}


def test_run(spark):
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None
