"""Keeping term statistics up to date while documents arrive.

Every micro-batch is reduced to its own document frequencies and its number of documents,
written under its batch number. Writing the same batch again replaces it, so a batch that is
repeated after a failure counts once. Statistics are sums over batches; no state has to be kept.
``compact`` adds up old batches, so that a read does not go through all of them.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import tokenize_terms
from textloom.operators.weights import tfidf_arrival
from textloom.session import materialize
from textloom.sources.documents import DOCUMENTS

TERMS, WEIGHTS = "terms", "weights"
WEIGHED = "doc_id long, term string, w double"
# The number of documents is the frequency of the null term, which every document holds.
COUNTS = "term string, df long"
UPTO = "upto long"


def document_stream(
    spark: SparkSession, folder: str, glob: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Documents of files that appear in ``folder``."""
    reader = spark.readStream.schema(DOCUMENTS).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder).select("doc_id", "text")


def counted(documents: DataFrame, tokens: Column) -> DataFrame:
    """``(term, df)`` of a batch and, for a null term, its number of documents: one pass over the texts."""
    held = F.concat(F.array_distinct(tokens), F.array(F.lit(None).cast("string")))
    return documents.select(F.explode(held).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def ingest(
    documents: DataFrame, counts_path: str, checkpoint: str, tokens: Column | None = None
) -> None:
    """Add all documents that have arrived to the statistics below ``counts_path``."""
    found = tokenize_terms("text") if tokens is None else tokens

    def count_batch(batch: DataFrame, number: int) -> None:
        counted(batch, found).write.mode("overwrite").parquet(f"{counts_path}/{TERMS}/batch={number}")

    (
        documents.writeStream.foreachBatch(count_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def ingest_weights(
    documents: DataFrame, counts_path: str, checkpoint: str, tokens: Column | None = None
) -> None:
    """Weigh all documents that have arrived by what was known on their arrival: tf * log10(N / df),
    N and df counting the documents that came no later.

    Batches arrive in order, the documents of a batch by ascending ``doc_id``. A batch starts from the
    sums over the batches before it, which outlive a run, and is written with its own
    statistics under its number: repeated, it starts from the same sums and replaces itself. ``compact``
    and the reads of statistics work here as they do after ``ingest``.
    """
    found = tokenize_terms("text") if tokens is None else tokens

    def weigh_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = materialize(batch.select("doc_id", "text"), "arrived")
        upto = _compacted(spark, counts_path)
        earlier = _counts(spark, counts_path, upto).where(F.col("batch") < number)
        seen = materialize(_summed(earlier), "seen-terms")
        n_seen = _size(seen).first()["n_docs"]
        tables = {
            WEIGHTS: tfidf_arrival(rows, found, seen=seen.where("term IS NOT NULL"), n_seen=n_seen),
            TERMS: counted(rows, found),
        }
        for kind, table in tables.items():
            table.write.mode("overwrite").parquet(f"{counts_path}/{kind}/batch={number}")

    (
        documents.writeStream.foreachBatch(weigh_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def ingested_weights(spark: SparkSession, counts_path: str) -> DataFrame:
    """``(doc_id, term, w)`` of all batches so far."""
    return _table(spark, WEIGHED, f"{counts_path}/{WEIGHTS}").select("doc_id", "term", "w")


def _table(spark: SparkSession, schema: str, path: str) -> DataFrame:
    """The table at ``path``, empty where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _compacted(spark: SparkSession, counts_path: str) -> int:
    """The last batch that was added up, -1 if none was."""
    last = _table(spark, UPTO, f"{counts_path}/compacted").agg(F.max("upto")).first()[0]
    return -1 if last is None else last


def _counts(spark: SparkSession, counts_path: str, upto: int) -> DataFrame:
    """What was added up to batch ``upto``, and the batches after it."""
    later = _table(spark, f"{COUNTS}, batch long", f"{counts_path}/{TERMS}")
    later = later.where(F.col("batch") > upto)
    if upto < 0:
        return later
    merged = spark.read.schema(COUNTS).parquet(f"{counts_path}/merged/upto={upto}")
    return later.unionByName(merged.withColumn("batch", F.lit(upto).cast("long")))


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.sum("df").alias("df"))


def _size(counts: DataFrame) -> DataFrame:
    return counts.where("term IS NULL").agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n_docs"))


def ingested_frequency(spark: SparkSession, counts_path: str) -> DataFrame:
    """``(term, df)`` over all batches so far."""
    counts = _counts(spark, counts_path, _compacted(spark, counts_path))
    return _summed(counts.where("term IS NOT NULL"))


def ingested_documents(spark: SparkSession, counts_path: str) -> DataFrame:
    """``(n_docs)`` over all batches so far: the N that weights need besides ``df``."""
    return _size(_counts(spark, counts_path, _compacted(spark, counts_path)))


def compact(spark: SparkSession, counts_path: str) -> int:
    """Add up all batches but the last, which a restarted stream may write again; returns the
    last batch that was added.

    Reads turn to the sums once their number is written, in one file, after them; if that
    fails, they go on with the batches, and the next call writes the sums again.
    """
    before = _compacted(spark, counts_path)
    batches = _table(spark, f"{COUNTS}, batch long", f"{counts_path}/{TERMS}")
    last = batches.agg(F.max("batch")).first()[0]
    if last is None or last - 1 <= before:
        return before
    upto = last - 1
    done = _counts(spark, counts_path, before).where(F.col("batch") <= upto)
    _summed(done).write.mode("overwrite").parquet(f"{counts_path}/merged/upto={upto}")
    spark.range(1).select(F.lit(upto).cast("long").alias("upto")).coalesce(1).write.mode(
        "append"
    ).parquet(f"{counts_path}/compacted")
    return upto
