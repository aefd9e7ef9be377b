"""Exact deduplication by a keyed state that is kept on disk and never expires.

Rows arrive as a stream of ``(digest, length, stable id, content locator)``. The state,
one entry per distinct content, holds the digest and length as its key and the
largest id, its locator and the number of arrivals as its value. Texts themselves are never
kept in the state: on a hit the full bytes are read again and compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators.joins import fits_broadcast
from textloom.session import materialize, scratch_path

ROWS_PER_SALT = 1_000
_STORE = "spark.sql.streaming.stateStore"
STATE_SETTINGS = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Many small stores: take disk as it is needed, not megabytes for each in advance.
    f"{_STORE}.rocksdb.allowFAllocate": "false",
    # All stores of an executor share this much memory beside its heap.
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "200",
}

ARRIVALS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("place", T.LongType()),
    ]
)


@contextmanager
def _on_disk(spark: SparkSession) -> Iterator[None]:
    """Within it, streams of this session keep their state on disk."""
    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def placed(docs: DataFrame, name: str = "_place") -> DataFrame:
    """``docs`` with a number that no two rows share: the id where none is null or repeated, else
    the row's place (partition and row in it), and then ``docs`` is written once with it."""
    ids = docs.select(F.col("doc_id").cast("long").alias("_id")).groupBy("_id").agg(F.count(F.lit(1)).alias("_n"))
    if ids.where("_id is null or _n > 1").isEmpty():
        return docs.withColumn(name, F.col("doc_id").cast("long"))
    return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "placed-rows")


def arrivals(docs: DataFrame, place: Column | None = None) -> DataFrame:
    """Digest, length, id and place (partition and row in it, unless given) of every row; a null
    text counts as an empty one."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        (F.monotonically_increasing_id() if place is None else place).alias("place"),
    )


def absorb(stream: DataFrame, checkpoint: str) -> None:
    """Take all rows of ``stream`` that have arrived into the state below ``checkpoint``.

    Called again with the same folder it goes on where it ended. The state is one hash
    aggregation without a watermark, so nothing in it expires; copies are combined before
    the shuffle, so a content held by a third of the rows is a few rows there.
    """
    with _on_disk(stream.sparkSession):
        (
            stream.groupBy("digest", "n_bytes")
            .agg(F.max(F.struct("doc_id", "place")), F.count(F.lit(1)))
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )


def state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(digest, n_bytes, keep_id, place, group_size)``: the keyed state as a table."""
    return spark.read.format("statestore").load(checkpoint).select(
        "key.digest",
        "key.n_bytes",
        F.col("value.max.doc_id").alias("keep_id"),
        F.col("value.max.place").alias("place"),
        F.col("value.count").alias("group_size"),
    )


def _meet(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(F.broadcast(right) if fits_broadcast(right) else right, keys)


def _salt(name: str, group_size: Column) -> Column:
    copies = F.ceil(group_size / F.lit(float(ROWS_PER_SALT)))
    return F.pmod(F.xxhash64(name), copies).alias("salt")


def compared(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """``(doc_id, digest, same)``: for every row whose digest was seen more than once, are
    its bytes those of the row that stays? ``hits`` are ``(doc_id, digest, keep_id,
    group_size)``. A content with many copies is dealt over salts of about a thousand
    rows, and the bytes that stay are sent once to each."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = _meet(texts, hits.distinct(), ["doc_id"])
    found = found.where(F.unhex(F.sha2("text", 256)) == F.col("digest"))
    stays = (
        found.where(F.col("doc_id") == F.col("keep_id"))
        .dropDuplicates(["digest"])
        .select(
            "digest",
            F.col("text").alias("kept_text"),
            F.explode(
                F.sequence(
                    F.lit(0).cast("long"),
                    F.ceil(F.col("group_size") / F.lit(float(ROWS_PER_SALT))) - 1,
                )
            ).alias("salt"),
        )
    )
    others = found.where(F.col("doc_id") != F.col("keep_id")).select(
        "doc_id", "digest", "text", _salt("doc_id", F.col("group_size"))
    )
    return others.join(stays, ["digest", "salt"]).select(
        "doc_id", "digest", "text", (F.col("text") == F.col("kept_text")).alias("same")
    )


def _grouped(docs: DataFrame, place: Column | None = None) -> DataFrame:
    """``(doc_id, place, digest, keep_id, keep_place, group_size)``: each row and the one row of its
    group that stays; the last three are null where no other row has its digest."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "exact-dedup")
    if folder is None:
        raise ValueError("the state needs a shared folder: set spark.checkpoint.dir")
    arrivals(docs, place).write.parquet(f"{folder}/arrivals")
    arrived = spark.read.schema(ARRIVALS).parquet(f"{folder}/arrivals")
    absorb(spark.readStream.schema(ARRIVALS).parquet(f"{folder}/arrivals"), f"{folder}/state")
    with _on_disk(spark):
        groups = state(spark, f"{folder}/state").withColumnRenamed("place", "keep_place")
        repeated = materialize(groups.where("group_size > 1"), "repeated-digests")
    hits = materialize(
        _meet(arrived.select("doc_id", "digest", "n_bytes"), repeated, ["digest", "n_bytes"]), "digest-hits"
    )
    differing = compared(docs, hits.select("doc_id", "digest", "keep_id", "group_size").where("doc_id is not null"))
    # Other bytes under a digest that was seen: such rows form groups of their own.
    apart = materialize(differing.where(~F.col("same")).select("doc_id", "digest", "text"), "collisions")
    rows = arrived.select("doc_id", "place", "digest")
    if apart.isEmpty():
        return rows.join(
            F.broadcast(small) if fits_broadcast(small := repeated.drop("n_bytes")) else small, "digest", "left"
        )
    own = apart.groupBy("digest", "text").agg(
        F.max("doc_id").alias("own_id"), F.count(F.lit(1)).alias("own_size")
    )
    members = apart.join(own, ["digest", "text"]).select("doc_id", "digest", "own_id", "own_size").distinct()
    less = own.groupBy("digest").agg(F.sum("own_size").alias("less"))
    # Of an id's rows in such a group the last one stays.
    last = rows.join(members.where("doc_id = own_id"), ["doc_id", "digest"]).groupBy("digest", "own_id").agg(
        F.max("place").alias("own_place")
    )
    return (
        rows.join(repeated.drop("n_bytes"), "digest", "left")
        .join(less, "digest", "left")
        .join(members, ["doc_id", "digest"], "left")
        .join(last, ["digest", "own_id"], "left")
        .select(
            "doc_id",
            "place",
            "digest",
            F.coalesce("own_id", "keep_id").alias("keep_id"),
            F.coalesce("own_place", "keep_place").alias("keep_place"),
            F.coalesce("own_size", F.col("group_size") - F.coalesce("less", F.lit(0))).alias("group_size"),
        )
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs``.

    Rows of ``docs(doc_id, text, ...)`` with the same bytes form a group; its largest
    ``doc_id`` stays. A null text equals an empty one. Rows that repeat an id count in
    ``group_size`` each, and each of them is ``kept`` if the id is. A null id never stays beside
    an id that is not null; alone in its group it stays, with a null ``keep_id``. No row
    gives no row. Other columns are not looked at.
    """
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return _grouped(docs).select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every group of equal texts, all columns as they came.

    It is a row of the largest id; of rows that repeat it, or of null ids alone, the last one. Rows
    are told apart by the numbers of ``placed``.
    """
    rows = placed(docs)
    gone = materialize(
        _grouped(rows, F.col("_place")).where("place != keep_place").select(F.col("place").alias("_gone")),
        "dropped-rows",
    )
    listed = F.broadcast(gone) if fits_broadcast(gone) else gone
    return rows.join(listed, rows["_place"] == listed["_gone"], "left_anti").drop("_place")
