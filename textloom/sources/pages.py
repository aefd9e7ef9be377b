"""Web pages as documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.html import page_text
from textloom.sources.commits import publish, published
from textloom.sources.documents import spread

STORED = "doc_id long, text string"
PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spread(spark.read.schema(PAGES).parquet(path), "page_id")


def page_texts(pages: DataFrame) -> DataFrame:
    """``(page_id, text)``: the visible text of each page."""
    return pages.select("page_id", page_text("html").alias("text"))


def page_documents(pages: DataFrame) -> DataFrame:
    """``(doc_id, text)``: one stored document per page, its address as the first line."""
    return pages.select(
        F.col("page_id").alias("doc_id"),
        F.concat_ws("\n", "url", page_text("html")).alias("text"),
    )


def append_documents(documents: DataFrame, path: str) -> None:
    """Add documents to a stored collection."""
    documents.write.mode("append").parquet(path)


def publish_documents(documents: DataFrame, path: str, run: str) -> bool:
    """Add documents to a collection as one run; the same run again adds nothing."""
    spark = documents.sparkSession
    return publish(spark, path, run, lambda folder: documents.select("doc_id", "text").write.parquet(folder))


def published_documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents of all runs that a collection holds in whole."""
    folders = list(published(spark, path).values())
    return spark.read.schema(STORED).parquet(*folders) if folders else spark.createDataFrame([], STORED)
