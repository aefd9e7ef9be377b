"""Joins that stay safe when the data, the vocabulary or one hot key grows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.session import materialize

BROADCAST_BYTES = 64 << 20
HOT_KEYS = 10_000
SALTS = 64
ROWS_PER_TASK = 10_000_000
LISTED_KEYS = 500_000  # keys beyond ROWS_PER_TASK that a list may hold: it is broadcast


def _row_bytes(schema: T.StructType) -> Column:
    """Estimated bytes of one row in a broadcast hash table."""
    size = F.lit(32)
    for field in schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + 8 + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + 8 + F.coalesce(F.octet_length(F.to_json(field.name)), F.lit(0))
        else:
            size = size + 8
    return size.cast("long")


def fits_broadcast(table: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure ``table``: may every executor hold a copy of it?"""
    measured = table.agg(F.sum(_row_bytes(table.schema)).alias("bytes")).first()
    return (measured["bytes"] or 0) <= limit


def hot_keys(
    counts: DataFrame,
    key: str,
    count: str,
    hot: int = HOT_KEYS,
    salts: int = SALTS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``(key, _salts)``: keys holding more than 1/hot of all rows or more rows than one
    task should, and over how many tasks to deal each, so that its count bounds none of them.

    By that rule there are fewer than ``hot + LISTED_KEYS``: on more rows than that many
    tasks hold, tasks are larger.
    """
    total = counts.agg(F.sum(count).alias("total")).first()["total"] or 0
    share = max(rows_per_task, -(-total // LISTED_KEYS))
    needed = F.ceil(2 * F.col(count) / share).cast("long")  # dealt by hash, so with room to spare
    return counts.where(F.col(count) > min(total / hot, share)).select(
        key, F.greatest(F.lit(salts).cast("long"), needed).alias("_salts")
    )


def drop_listed(rows: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is not in the table ``listed``, such as a stop list."""
    listed = listed.select(key).distinct()
    return rows.join(F.broadcast(listed) if fits_broadcast(listed) else listed, key, "left_anti")


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    counts: DataFrame | None = None,
    count: str = "n",
    limit: int = BROADCAST_BYTES,
    hot: int = HOT_KEYS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left join of many ``rows`` with a ``table`` holding each ``key`` at most once.

    A table measured to be small is broadcast, so the rows are not shuffled at all.
    Otherwise the rows of hot keys (see ``hot_keys``) and of null keys meet
    a broadcast of just those entries, and only the rest is shuffled by key.
    ``counts`` may give the number of rows per key where it is known already; otherwise
    the rows are written once and counted, since this way reads them several times.
    """
    if fits_broadcast(table, limit):
        return rows.join(F.broadcast(table), key, "left")
    if counts is None:
        rows = materialize(rows, "rows")
        counts = materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "key-counts")
        count = "n"
    heavy = hot_keys(counts.where(F.col(key).isNotNull()), key, count, hot, rows_per_task=rows_per_task)
    heavy = heavy.select(key)
    marked = rows.join(
        F.broadcast(heavy.withColumn("_heavy", F.lit(True))), key, "left"
    )
    aside = F.coalesce("_heavy", F.col(key).isNull())
    heavy_table = table.join(F.broadcast(heavy), key, "left_semi")
    heavy_rows = marked.where(aside).drop("_heavy")
    light_rows = marked.where(~aside).drop("_heavy")
    return heavy_rows.join(F.broadcast(heavy_table), key, "left").unionByName(
        light_rows.join(table, key, "left")
    )


def expanding_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    spread: str,
    counts: DataFrame | None = None,
    count: str = "n",
    limit: int = BROADCAST_BYTES,
    hot: int = HOT_KEYS,
    salts: int = SALTS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Inner join of many ``rows`` with a ``table`` in which a ``key`` may repeat.

    A small table is broadcast. Otherwise both sides are shuffled by the key and a
    salt: rows of hot keys are dealt by column ``spread`` over at least ``salts`` tasks, and
    over as many more as their number asks for; the table's entries for just those keys are
    copied to each of them.
    """
    if fits_broadcast(table, limit):
        return rows.join(F.broadcast(table), key)
    if counts is None:
        rows = materialize(rows, "rows")
        counts = materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "key-counts")
        count = "n"
    heavy = F.broadcast(hot_keys(counts, key, count, hot, salts, rows_per_task))
    copied = table.join(heavy, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1).cast("long")) - 1))
    )
    return salted(rows, heavy, key, spread).join(copied.drop("_salts"), [key, "_salt"]).drop("_salt")


def salted(rows: DataFrame, heavy: DataFrame, key: str, spread: str) -> DataFrame:
    """``rows`` with a ``_salt``: one of its ``_salts`` for a hot key, 0 for any other."""
    salts = F.coalesce("_salts", F.lit(1).cast("long"))
    return rows.join(heavy, key, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), salts)).drop("_salts")
