"""Reading document collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.text import line

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Deal a scan of few, small files over all cores; leave a large scan as it is.

    Only for direct scans: tokenizing is the costly step, and a file with one row group
    would be tokenized by one task. A scan with as many splits as cores is not shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan


def read_documents(spark: SparkSession, path: str, columns: tuple[str, ...] = ("doc_id", "text")):
    """``documents`` as a table of the given columns."""
    return spread(spark.read.schema(DOCUMENTS).parquet(path).select(*columns), "doc_id")


def read_folder(
    spark: SparkSession, path: str, glob: str = "*", recursive: bool = False
) -> DataFrame:
    """Every file below ``path`` as ``(doc_id, path, text)``; the id is a hash of the path,
    so it is the same in every run and unique over sub-folders."""
    files = spark.read.text(
        path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=recursive
    )
    return files.select(
        F.xxhash64(F.col("_metadata.file_path")).alias("doc_id"),
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("text"),
    )


def document_listing(corpus: DataFrame, *keys: str | Column) -> DataFrame:
    """First and second line of each document: its address and its title."""
    return corpus.select(
        *(keys or ("doc_id",)), line("text", 1).alias("url"), line("text", 2).alias("title")
    )


def corpus_profile(corpus: DataFrame) -> DataFrame:
    """Number of documents and their size in bytes."""
    return corpus.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("n_bytes"),
    )
