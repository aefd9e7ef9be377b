import pytest
import shutil

from pyspark.sql import functions as F

from textloom.plans import catalog
from textloom import session
from textloom.functions import text as tx
from textloom.operators import index
from textloom.sources import commits
from textloom.sources import documents as docs
from textloom.sources import pages, reports
from textloom.streaming import ingest


def test_folder_listing_and_profile(spark, tmp_path, rows_of):
    (tmp_path / "sub").mkdir()
    (tmp_path / "one.txt").write_text("http://a\n Title \nbody ä\n", encoding="utf-8")
    (tmp_path / "two.txt").write_text("only line", encoding="utf-8")
    (tmp_path / "notes.md").write_text("x\ny", encoding="utf-8")
    (tmp_path / "sub" / "one.txt").write_text("deep", encoding="utf-8")
    texts = docs.read_folder(spark, str(tmp_path), "*.txt")
    assert rows_of(docs.document_listing(texts).drop("doc_id"), "url") == [
        ("http://a", "Title"), ("only line", ""),
    ]
    everything = docs.read_folder(spark, str(tmp_path), recursive=True)
    assert everything.select("doc_id").distinct().count() == 4
    assert rows_of(docs.corpus_profile(everything)) == [(4, 25 + 9 + 3 + 4)]
    assert rows_of(docs.corpus_profile(everything.limit(0))) == [(0, 0)]


def test_small_scan_is_spread_and_large_one_is_not(spark):
    small = spark.range(0, 10, 1, 1).withColumnRenamed("id", "doc_id")
    cores = spark.sparkContext.defaultParallelism
    assert docs.spread(small, "doc_id").rdd.getNumPartitions() == cores
    large = spark.range(0, 1000, 1, cores + 1).withColumnRenamed("id", "doc_id")
    assert docs.spread(large, "doc_id") is large


def test_page_documents_are_appended(spark, tmp_path, rows_of):
    stored = spark.createDataFrame(
        [(7, "http://a", "<h1>A</h1><p>b")], "page_id bigint, url string, html string"
    )
    made = pages.page_documents(stored)
    assert rows_of(made) == [(7, "http://a\nA\nb")]
    pages.append_documents(made, str(tmp_path / "all"))
    pages.append_documents(made.withColumn("doc_id", F.lit(8).cast("bigint")), str(tmp_path / "all"))
    assert spark.read.parquet(str(tmp_path / "all")).count() == 2


def test_reports(spark, tmp_path):
    path = F.concat(F.lit("/d/"), F.col("doc_id").cast("string"))
    report = spark.createDataFrame(
        [(1, "german", "german", "de")],
        "doc_id bigint, freq_result string, short_result string, model_result string",
    )
    reports.write_report(reports.language_blocks(report, path), str(tmp_path / "language"))
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "language").glob("part-*"))
    assert text == (
        "Файл: /d/1\nМетод частотных слов: german\nМетод коротких слов: german\n"
        "Нейросетевой метод: de\nСсылка на документ: file:///d/1\n\n"
    )
    analysis = spark.createDataFrame(
        [(1, ["One.", "Two."], "one --- 0.5\n")],
        "doc_id bigint, summary array<string>, keywords string",
    )
    block = reports.summary_blocks(analysis, path).first()["block"]
    assert block == (
        "Файл: /d/1\n\nКлассический реферат:\n- One.\n- Two.\n\nСписок ключевых слов:\none --- 0.5\n"
    )


def test_a_run_is_published_once(spark, tmp_path, rows_of, monkeypatch):
    path = str(tmp_path / "all")
    made = spark.createDataFrame([(7, "a"), (8, "b")], "doc_id bigint, text string")
    assert rows_of(pages.published_documents(spark, path)) == []
    assert pages.publish_documents(made, path, "one")
    assert not pages.publish_documents(made, path, "one")
    assert pages.publish_documents(made.where("doc_id = 8"), path, "two")
    assert rows_of(pages.published_documents(spark, path), "doc_id") == [(7, "a"), (8, "b"), (8, "b")]


def test_a_part_without_its_entry_is_not_seen(spark, tmp_path, rows_of):
    """A run that fails between its two writes is invisible, and can be made again."""
    path = str(tmp_path / "report")
    blocks = spark.createDataFrame([(1, "x\ny")], "doc_id bigint, block string")

    def lost(folder):
        reports.write_report(blocks, folder)
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        commits.publish(spark, path, "one", lost)
    assert list((tmp_path / "report" / "parts").iterdir())
    assert rows_of(reports.published_lines(spark, path)) == []
    assert reports.publish_report(blocks, path, "one")
    assert not reports.publish_report(blocks, path, "one")
    assert rows_of(reports.published_lines(spark, path), "line") == [("x",), ("y",)]


def test_stream_in_two_runs_equals_the_batch(spark, tmp_path, rows_of):
    """Files that come later are added; files seen before are not counted again."""
    whole = docs.read_documents(
        spark, "/root/testdata/sf0.001/documents.parquet", tuple(docs.DOCUMENTS.fieldNames())
    )
    parts = tmp_path / "parts"
    whole.repartition(4).write.parquet(str(parts))
    files = sorted(parts.glob("*.parquet"))
    assert len(files) == 4
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    counts, log = str(tmp_path / "counts"), str(tmp_path / "log")
    for arriving in (files[:3], files[3:]):
        for file in arriving:
            shutil.copy(file, inbox)
        ingest.ingest(ingest.document_stream(spark, str(inbox), files_per_batch=2), counts, log)
    batch = rows_of(index.doc_frequency(whole, tx.tokenize_terms("text")), "term")

    def state():
        return rows_of(ingest.ingested_frequency(spark, counts), "term"), rows_of(ingest.ingested_documents(spark, counts))

    assert state() == (batch, [(whole.count(),)])
    # Three batches: two are added up, the last may still be written again.
    assert ingest.compact(spark, counts) == 1
    assert state() == (batch, [(whole.count(),)])
    read = ingest.ingested_frequency(spark, counts).inputFiles()
    assert any("merged/upto=1" in file for file in read)
    assert ingest.compact(spark, counts) == 1
    shutil.copy(files[0], inbox / "again.parquet")
    ingest.ingest(ingest.document_stream(spark, str(inbox), files_per_batch=2), counts, log)
    assert ingest.compact(spark, counts) == 2
    more = spark.read.parquet(str(files[0]))
    assert state()[1] == [(whole.count() + more.count(),)]
    total = index.doc_frequency(whole.unionByName(more), tx.tokenize_terms("text"))
    assert state()[0] == rows_of(total, "term")


def test_no_batch_yet(spark, tmp_path, rows_of):
    counts = str(tmp_path / "counts")
    assert ingest.compact(spark, counts) == -1
    assert rows_of(ingest.ingested_frequency(spark, counts)) == []
    assert rows_of(ingest.ingested_documents(spark, counts)) == [(0,)]


def test_scratch_follows_the_session(spark, tmp_path):
    class Context:
        master, applicationId = "spark://somewhere", "app"

    class Session:
        sparkContext = Context()

        def __init__(self, **conf):
            self.conf = conf

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session())
    named = Session(**{"spark.checkpoint.dir": "hdfs://shared/tmp/"})
    assert session.scratch_dir(named) == "hdfs://shared/tmp"
    assert session.scratch_dir(spark) == session.scratch_dir(spark)
    df = spark.range(3)
    assert sorted(r["id"] for r in session.materialize(df, "t").collect()) == [0, 1, 2]


def test_arriving_parts_keep_the_splits_of_the_table(spark, tmp_path):
    """No part is written, or read again, by a single task."""
    rows = spark.range(60).selectExpr("id AS doc_id", "concat('red blue', id) AS text", "'en' AS lang", "'x' AS source", "10L AS n_chars")
    rows.repartition(4, "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    parts = catalog._in_three(spark, str(tmp_path))
    assert [part.count() for part in parts] == [20, 20, 20]
    for part in parts:
        part.write.mode("append").parquet(f"{tmp_path}/arriving")
    files = spark.read.parquet(f"{tmp_path}/arriving").inputFiles()
    assert len(files) > 3
    found = catalog.tfidf_arrival_stream(spark, str(tmp_path))
    assert sorted(found.collect()) == sorted(catalog.tfidf_arrival(spark, str(tmp_path)).collect())
