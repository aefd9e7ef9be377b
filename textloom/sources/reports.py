"""Text reports, one block per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.sources.commits import publish, published

# The labels of both report formats.
FILE_LABEL = "Файл: "
FREQUENT_LABEL = "Метод частотных слов: "
SHORT_LABEL = "Метод коротких слов: "
MODEL_LABEL = "Нейросетевой метод: "
LINK_LABEL = "Ссылка на документ: file://"
SUMMARY_LABEL = "Классический реферат:"
KEYWORDS_LABEL = "Список ключевых слов:"


def _labelled(label: str, value: Column | str) -> Column:
    return F.concat(F.lit(label), value)


def language_blocks(report: DataFrame, path: Column) -> DataFrame:
    """``(doc_id, block)``: five lines per document and an empty one after them."""
    return report.select(
        "doc_id",
        F.concat_ws(
            "\n",
            _labelled(FILE_LABEL, path),
            _labelled(FREQUENT_LABEL, "freq_result"),
            _labelled(SHORT_LABEL, "short_result"),
            _labelled(MODEL_LABEL, "model_result"),
            _labelled(LINK_LABEL, path),
            F.lit(""),
        ).alias("block"),
    )


def summary_blocks(analysis: DataFrame, path: Column) -> DataFrame:
    """``(doc_id, block)``: the file, a bulleted summary and the keyword list."""
    bullets = F.array_join(
        F.transform("summary", lambda sentence: F.concat(F.lit("- "), sentence, F.lit("\n"))), ""
    )
    return analysis.select(
        "doc_id",
        F.concat(
            _labelled(FILE_LABEL, path),
            F.lit(f"\n\n{SUMMARY_LABEL}\n"),
            bullets,
            F.lit(f"\n{KEYWORDS_LABEL}\n"),
            "keywords",
        ).alias("block"),
    )


def write_report(blocks: DataFrame, path: str) -> None:
    """Write the blocks as text files; a block is never torn apart."""
    blocks.select("block").write.option("lineSep", "\n").text(path)


def publish_report(blocks: DataFrame, path: str, run: str) -> bool:
    """Add the blocks to a report as one run; the same run again adds nothing."""
    return publish(blocks.sparkSession, path, run, lambda folder: write_report(blocks, folder))


def published_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line)``: the lines of all runs that a report holds in whole."""
    folders = list(published(spark, path).values())
    if not folders:
        return spark.createDataFrame([], "line string")
    return spark.read.option("lineSep", "\n").text(folders).withColumnRenamed("value", "line")
