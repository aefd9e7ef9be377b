"""An index that grows: segments, tombstones and a manifest for every snapshot.

An added batch of documents becomes a segment of its own; nothing written before is touched.
Deleting writes tombstones: ids, and the last segment they hold for. A document that is added again
lives from its new segment on, and its older forms are dead. Each change ends by writing one small
file, the manifest of the new snapshot, which lists the segments and tombstones it is made of: until
then readers see the snapshot before, whatever happened on the way. A change carries the id of its
run, and a run that is already in the manifest changes nothing, so that it can be repeated.
Merging writes all living postings as one segment, ranged by term. One writer at a time; any number
of readers, who may stay with an older snapshot.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import tokenize_terms
from textloom.operators.index import Index, posting_frequency, term_frequency
from textloom.operators.joins import fits_broadcast
from textloom.session import materialize

SEGMENT, TOMBSTONES = "segment", "tombstones"
MANIFEST = "version long, runs array<string>, parts array<struct<kind:string, seq:long, folder:string, n_docs:long>>"
POSTINGS = "doc_id long, term string, tf long"
STATS = "term string, df long"
DEAD = "doc_id long, upto long"


@dataclass(frozen=True)
class Snapshot:
    """What a manifest lists. ``parts`` are (kind, seq, folder, n_docs) in the order they were added."""

    version: int
    runs: tuple[str, ...]
    parts: tuple[tuple[str, int, str, int], ...]

    def of(self, kind: str) -> list[tuple[str, int, str, int]]:
        return [part for part in self.parts if part[0] == kind]

    def next_seq(self) -> int:
        return 1 + max((part[1] for part in self.parts), default=-1)


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """The newest snapshot below ``path``, or that of ``version``; an empty one where nothing was written."""
    try:
        manifests = spark.read.schema(MANIFEST).parquet(f"{path}/manifests")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        manifests = None
    if manifests is not None:
        if version is not None:
            manifests = manifests.where(F.col("version") == version)
        last = manifests.orderBy(F.desc("version")).limit(1).collect()
        if last:
            return Snapshot(last[0]["version"], tuple(last[0]["runs"]), tuple(tuple(part) for part in last[0]["parts"]))
    if version not in (None, -1):
        raise ValueError(f"no snapshot {version} of the index at {path}")
    return Snapshot(-1, (), ())


def _commit(spark: SparkSession, path: str, made: Snapshot) -> Snapshot:
    """One row in one file: it is there or it is not."""
    row = (made.version, list(made.runs), list(made.parts))
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifests")
    return made


def _folder(kind: str) -> str:
    # A repeated or failed run never writes where another one did.
    return f"{kind}-{uuid.uuid4().hex}"


def _write_segment(path: str, folder: str, postings: DataFrame, docs: DataFrame) -> int:
    spark = postings.sparkSession
    postings.write.parquet(f"{path}/{folder}/postings")
    posting_frequency(spark.read.schema(POSTINGS).parquet(f"{path}/{folder}/postings")).write.parquet(f"{path}/{folder}/stats")
    docs.write.parquet(f"{path}/{folder}/docs")
    return spark.read.schema("doc_id long").parquet(f"{path}/{folder}/docs").count()


def _read(spark: SparkSession, path: str, part: tuple[str, int, str, int], table: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/{part[2]}/{table}").withColumn("_seq", F.lit(part[1]).cast("long"))


def _all(spark: SparkSession, path: str, parts: list, table: str, schema: str) -> DataFrame:
    """One table of several segments, by a scan for each."""
    if not parts:
        return spark.createDataFrame([], f"{schema}, _seq long")
    read = [_read(spark, path, part, table, schema) for part in parts]
    while len(read) > 1:  # in pairs, so that the plan is not as deep as there are segments
        read = [a.unionByName(b[0]) if b else a for a, *b in (read[i : i + 2] for i in range(0, len(read), 2))]
    return read[0]


def _dead(spark: SparkSession, path: str, state: Snapshot) -> DataFrame:
    """``(doc_id, upto)``: up to which segment a document is dead, each id once."""
    tombs = _all(spark, path, state.of(TOMBSTONES), "ids", DEAD)
    return tombs.groupBy("doc_id").agg(F.max("upto").alias("upto"))


def _alive(rows: DataFrame, dead: DataFrame) -> DataFrame:
    dead = dead.withColumnRenamed("doc_id", "_id")
    dead = F.broadcast(dead) if fits_broadcast(dead) else dead
    return rows.join(dead, (rows["doc_id"] == dead["_id"]) & (rows["_seq"] <= dead["upto"]), "left_anti")


def append(spark: SparkSession, path: str, corpus: DataFrame, run: str, tokens: Column | None = None) -> Snapshot:
    """Add ``corpus(doc_id, text)`` as a segment; documents it holds already are replaced.

    Ids are unique within a batch and not null. An empty batch is a segment without documents.
    """
    state = snapshot(spark, path)
    if run in state.runs:
        return state
    folder, seq = _folder(SEGMENT), state.next_seq()
    postings = term_frequency(corpus, tokenize_terms("text") if tokens is None else tokens)
    size = _write_segment(path, folder, postings, corpus.select("doc_id"))
    parts = [*state.parts, (SEGMENT, seq, folder, size)]
    # Older forms of these documents are dead up to the segment before.
    added = spark.read.schema("doc_id long").parquet(f"{path}/{folder}/docs")
    older = _all(spark, path, state.of(SEGMENT), "docs", "doc_id long")
    again = older.join(F.broadcast(added) if fits_broadcast(added) else added, "doc_id", "left_semi").select("doc_id")
    again = materialize(again.distinct().withColumn("upto", F.lit(seq - 1).cast("long")), "replaced")
    if not again.isEmpty():
        parts.append(_tombstones(path, again, seq))
    return _commit(spark, path, Snapshot(state.version + 1, (*state.runs, run), tuple(parts)))


def _tombstones(path: str, dead: DataFrame, seq: int) -> tuple[str, int, str, int]:
    folder = _folder(TOMBSTONES)
    dead.write.parquet(f"{path}/{folder}/ids")
    return TOMBSTONES, seq, folder, 0


def delete(spark: SparkSession, path: str, ids: DataFrame, run: str) -> Snapshot:
    """Take the documents of ``ids(doc_id)`` out; unknown ids do nothing."""
    state = snapshot(spark, path)
    if run in state.runs:
        return state
    last = max((part[1] for part in state.of(SEGMENT)), default=-1)
    dead = ids.select(F.col("doc_id").cast("long")).where("doc_id IS NOT NULL").distinct()
    part = _tombstones(path, dead.withColumn("upto", F.lit(last).cast("long")), state.next_seq())
    return _commit(spark, path, Snapshot(state.version + 1, (*state.runs, run), (*state.parts, part)))


def documents(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``(doc_id)`` of the living documents."""
    state = snapshot(spark, path, version)
    docs = _all(spark, path, state.of(SEGMENT), "docs", "doc_id long")
    return (_alive(docs, _dead(spark, path, state)) if state.of(TOMBSTONES) else docs).select("doc_id")


def load(spark: SparkSession, path: str, version: int | None = None) -> Index:
    """The index as of a snapshot, the newest unless ``version`` is given.

    Without tombstones statistics are those of the segments added up. With them, what the dead
    documents contributed is taken off: only their postings are counted again, not all.
    """
    state = snapshot(spark, path, version)
    segments = state.of(SEGMENT)
    postings = _all(spark, path, segments, "postings", POSTINGS)
    stats = _all(spark, path, segments, "stats", STATS).select("term", "df")
    n_docs = sum(part[3] for part in segments)
    if state.of(TOMBSTONES):
        dead = materialize(_dead(spark, path, state), "dead-documents")
        docs = _all(spark, path, segments, "docs", "doc_id long")
        gone = dead.withColumnRenamed("doc_id", "_id")
        gone = F.broadcast(gone) if fits_broadcast(gone) else gone

        def killed(rows: DataFrame) -> DataFrame:
            return rows.join(gone, (rows["doc_id"] == gone["_id"]) & (rows["_seq"] <= gone["upto"]), "left_semi")

        n_docs -= killed(docs).count()
        off = posting_frequency(killed(postings)).select("term", (-F.col("df")).alias("df"))
        stats = stats.unionByName(off)
        postings = _alive(postings, dead)
    stats = stats.groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")
    return Index(postings.select("doc_id", "term", "tf"), materialize(stats, "term-stats"), n_docs)


def merge(spark: SparkSession, path: str, run: str) -> Snapshot:
    """Write all living postings as one segment, without tombstones. Appends write them as they come, without
    a shuffle; here they are ranged by term, so that a query reads few row groups. Readers of older
    snapshots keep their files; nothing is deleted."""
    state = snapshot(spark, path)
    if run in state.runs:
        return state
    folder = _folder(SEGMENT)
    living = load(spark, path).postings.repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id")
    size = _write_segment(path, folder, living, documents(spark, path))
    part = (SEGMENT, state.next_seq(), folder, size)
    return _commit(spark, path, Snapshot(state.version + 1, (*state.runs, run), (part,)))
