"""Ranked search that skips: posting blocks with their greatest weight, and a floor for every query.

Documents are dealt out by a hash, ordered by the length of their vectors within each deal and cut into
blocks, so that a block's weights are of one size. A term's postings in a block are one row: the documents, their weights, and the
greatest of these. A query's best possible score in a block is the sum of what its terms give there
at most. A few blocks of the highest such sums are scored first, and the k-th best score found is a
floor: other blocks that cannot reach it are skipped, and within the rest the lists of the terms that
cannot reach it together (MaxScore) are looked up only for documents that may still reach it.
Nothing is approximate: the floor is the score of documents that were found.

What is shuffled is the postings, packed by document, when blocks are made, and the lists of the asked
terms, once and whatever the number of queries, when they are searched: all else of a block is done where
its lists are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from textloom.operators.index import Index
from textloom.operators.joins import BROADCAST_BYTES, expanding_join, fits_broadcast, lookup_join
from textloom.operators.search import PAIRS_PER_TASK, SCORE_DIGITS, query_vectors
from textloom.operators.weights import document_norms, smooth_idf
from textloom.session import dealt_once, materialize

DOCS_PER_BLOCK = 64
DOCS_PER_DEAL = 1024
BLOCKS_PER_DEAL = 1 << 32  # numbers kept for them
POSTINGS_PER_TASK = 500_000
SEED_DOCS = 8  # documents scored for the floor, times k
# A rounded score may be this much above the score, and sums of bounds stray in their last digits.
MARGIN = 10.0**-SCORE_DIGITS


@dataclass(frozen=True)
class BlockIndex:
    """Postings in blocks: ``lists(term, block, top, doc_ids, parts)``, each file sorted by term and block.

    A part is tf over the length of the document's vector, and ``top`` the greatest one.
    """

    lists: DataFrame
    stats: DataFrame  # term, df
    n_docs: int
    docs_per_block: int

    def save(self, path: str) -> None:
        self.lists.repartitionByRange("term", "block").sortWithinPartitions("term", "block").write.parquet(f"{path}/lists")
        self.stats.repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{path}/stats")
        self.stats.sparkSession.range(1).select(
            F.lit(self.n_docs).cast("long").alias("n_docs"), F.lit(self.docs_per_block).alias("docs_per_block")
        ).write.parquet(f"{path}/size")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BlockIndex:
        size = spark.read.parquet(f"{path}/size").first()
        return BlockIndex(
            spark.read.parquet(f"{path}/lists"), spark.read.parquet(f"{path}/stats"), size["n_docs"], size["docs_per_block"]
        )


def _packed(batches: Iterable) -> Iterator:
    """Neighbouring postings ``(doc_id, term, tf)`` of a document as one row: its terms joined by a zero
    character, and their numbers. Batches with that character in a term keep a row for each posting."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        doc, term, tf = batch.columns
        n = batch.num_rows
        if not n:
            continue
        if pc.any(pc.match_substring(term, "\0")).as_py():
            starts = pa.array(range(n + 1), pa.int32())
        else:
            cuts = pc.indices_nonzero(pc.not_equal(doc.slice(1), doc.slice(0, n - 1)))
            starts = pa.array([0, *(pc.add(cuts, 1).to_pylist()), n], pa.int32())
        terms = pc.binary_join(pa.ListArray.from_arrays(starts, term), "\0")
        yield pa.RecordBatch.from_arrays(
            [doc.take(starts.slice(0, len(starts) - 1)), terms, pa.ListArray.from_arrays(starts, tf)],
            ["doc_id", "_terms", "tf"],
        )


def in_blocks(index: Index, docs_per_block: int = DOCS_PER_BLOCK, limit: int = BROADCAST_BYTES) -> BlockIndex:
    """The block form of an index, written to the shared folder.

    Documents are dealt out by a hash of their id and seated in a deal by the length of their vectors; a
    block is a run of seats, so it never holds more than ``docs_per_block`` documents and its lists are no
    longer. Where a document goes is known from its id, so postings are shuffled once, packed, and meet
    the seats and form the lists there.
    """
    cores = index.stats.sparkSession.sparkContext.defaultParallelism
    with dealt_once(index.stats.sparkSession):
        norms = materialize(document_norms(index) if index.norms is None else index.norms, "norms")
        n_docs, n_postings = norms.count(), index.stats.agg(F.sum("df")).first()[0] or 0
        deals = max(1, -(-n_docs // DOCS_PER_DEAL), min(cores, n_docs // (8 * docs_per_block)))
        tasks = min(deals, max(cores, -(-n_postings // POSTINGS_PER_TASK)))
        deal = F.pmod(F.xxhash64("doc_id"), F.lit(deals)).cast("long").alias("_deal")
        seat = F.row_number().over(Window.partitionBy("_deal").orderBy("norm", "doc_id")) - 1
        block = F.expr(f"_deal * {BLOCKS_PER_DEAL}L + _seat div {docs_per_block}").alias("block")
        seats = norms.select("doc_id", "norm", deal).repartition(tasks, "_deal").withColumn("_seat", seat)
        seats = seats.select("_deal", "doc_id", "norm", block)
        known = index.postings.select("doc_id", "term", "tf").where("doc_id IS NOT NULL AND term IS NOT NULL")
        fields = {field.name: field.dataType for field in known.schema}
        shape = T.StructType().add("doc_id", fields["doc_id"]).add("_terms", T.StringType()).add("tf", T.ArrayType(fields["tf"]))
        packed = known.mapInArrow(_packed, shape).select("doc_id", "_terms", "tf", deal).repartition(tasks, "_deal")
        seats = F.broadcast(seats) if fits_broadcast(seats, limit) else seats.hint("shuffle_hash")
        terms = F.when(F.size("tf") == 1, F.array("_terms")).otherwise(F.split("_terms", "\0")).alias("term")
        placed = packed.join(seats, ["_deal", "doc_id"]).select("_deal", "block", "doc_id", "norm", terms, "tf")
        placed = placed.select("_deal", "block", "doc_id", "norm", F.inline(F.arrays_zip("term", "tf")))
        part = F.struct("doc_id", (F.col("tf") / F.col("norm")).alias("part"))
        lists = placed.groupBy("_deal", "term", "block").agg(F.sort_array(F.collect_list(part)).alias("_list"))
        # An id that repeats adds up, so there the sum is what a list gives at most.
        once = F.size(F.array_distinct("_list.doc_id")) == F.size("_list")
        added = F.aggregate("_list.part", F.lit(0.0), lambda total, part: total + part)
        lists = lists.select(
            "term",
            "block",
            F.when(once, F.array_max("_list.part")).otherwise(added).alias("top"),
            F.col("_list.doc_id").alias("doc_ids"),
            F.col("_list.part").alias("parts"),
        )
        written = materialize(lists.sortWithinPartitions("term", "block"), "posting-blocks")
    return BlockIndex(written, index.stats, index.n_docs, docs_per_block)


def _met(built: BlockIndex, vectors: DataFrame, small: bool, limit: int, *lists: str, tasks: int = 0) -> DataFrame:
    """``(qid, block, term, x, gain)``: for each query and block, its terms there, their weight in the
    query and what they add to a score at most. Of the lists themselves only columns ``lists`` are read.

    With ``tasks``, what belongs to a query and block is in one of so many. Query tables that can be broadcast
    (``small``) meet the lists after these were dealt by block, so that a list moves once for all queries."""
    bounds = built.lists.select("term", "block", "top", *lists)
    if small:
        if tasks:
            bounds = bounds.join(F.broadcast(vectors.select("term").distinct()), "term", "left_semi").repartition(tasks, "block")
        met = bounds.join(F.broadcast(vectors), "term")
    else:
        counts = built.stats.select("term", F.ceil(F.col("df") / F.lit(float(built.docs_per_block))).alias("n"))
        met = expanding_join(bounds, vectors, "term", spread="block", counts=counts, limit=limit)
        met = met.repartition(tasks, "qid", "block") if tasks else met
    return met.select("qid", "block", "term", "x", (F.col("x") * F.col("top")).alias("gain"), *lists)


def _together(entries: DataFrame, blocks: DataFrame, limit: int) -> DataFrame:
    """``entries`` whose query and block are in ``blocks(qid, block, ...)``, dealt by query and block: whole lists
    are moved, once, and unfolded where they arrive."""
    if fits_broadcast(blocks, limit):
        return entries.join(F.broadcast(blocks), ["qid", "block"]).repartition("qid", "block")
    return entries.join(blocks.hint("merge"), ["qid", "block"])


def _unfolded(entries: DataFrame, *more: str) -> DataFrame:
    """``(qid, block, doc_id, part)``: what each listed posting gives its document."""
    rows = entries.select("qid", "block", "x", *more, F.inline(F.arrays_zip("doc_ids", "parts")))
    return rows.select("qid", "block", F.col("doc_ids").alias("doc_id"), (F.col("x") * F.col("parts")).alias("part"), *more)


def _kth(scored: DataFrame, k: int) -> DataFrame:
    """``(qid, floor)``: the k-th best score, of queries that have so many."""
    best = Window.partitionBy("qid").orderBy(F.desc("score"))
    ranked = scored.select("qid", F.round("part", SCORE_DIGITS).alias("score")).withColumn("_at", F.row_number().over(best))
    return ranked.where(F.col("_at") == k).select("qid", F.col("score").alias("floor"))


def _cuts(met: DataFrame, first: DataFrame, floors: DataFrame) -> DataFrame:
    """``(qid, block, least, begin, rest)`` of the blocks in reach that are not in ``first``: the floor less what
    rounding may hide, the gain from which on terms are needed to reach it, and what the others give at most."""
    running = Window.partitionBy("qid", "block").orderBy("gain", "term").rowsBetween(Window.unboundedPreceding, 0)
    met = met.join(first, ["qid", "block"], "left_anti").join(floors, "qid", "left")
    met = met.withColumn("least", F.coalesce("floor", F.lit(0.0)) - MARGIN)
    met = met.withColumn("needed", F.sum("gain").over(running) >= F.col("least"))
    cuts = met.groupBy("qid", "block").agg(
        F.first("least").alias("least"),
        F.min(F.when(F.col("needed"), F.col("gain"))).alias("begin"),
        F.sum(F.when(~F.col("needed"), F.col("gain"))).alias("rest"),
    )
    return cuts.where("begin IS NOT NULL")


def _entries(wide: DataFrame, cuts: DataFrame) -> DataFrame:
    """The lists that are unfolded to the end: those of the needed terms of blocks in reach."""
    return wide.join(cuts.hint("shuffle_hash"), ["qid", "block"]).where(F.col("gain") >= F.col("begin"))


def _hopeful(entries: DataFrame) -> DataFrame:
    """``(qid, block, asked, found, begin)``: the documents that may still reach the floor, and what they have so far."""
    found = _unfolded(entries, "least", "begin", "rest").groupBy("qid", "block", "doc_id").agg(
        F.sum("part").alias("part"), *[F.first(name).alias(name) for name in ("least", "begin", "rest")]
    )
    may = F.col("part") + F.coalesce("rest", F.lit(0.0)) >= F.col("least") - MARGIN
    own = F.collect_list(F.struct("doc_id", "part"))
    hopeful = found.where(may).groupBy("qid", "block").agg(own.alias("_own"), F.first("begin").alias("begin"))
    return hopeful.select("qid", "block", F.col("_own.doc_id").alias("asked"), F.col("_own.part").alias("found"), "begin")


def _looked_up(hopeful: DataFrame, wide: DataFrame) -> DataFrame:
    """``(qid, block, doc_id, part, own)``: what was found (``own``), and what the lists of the other terms give the
    documents that may still reach the floor."""
    # Rows with own meet no list: each query and block keeps one of them, in the same task.
    asking = hopeful.withColumn("own", F.explode(F.array(F.lit(True), F.lit(False))))
    others = wide.select(F.col("qid").alias("_qid"), F.col("block").alias("_block"), "x", "gain", "doc_ids", "parts")
    met = (F.col("qid") == F.col("_qid")) & (F.col("block") == F.col("_block"))
    met = met & ~F.col("own") & (F.col("gain") < F.col("begin"))
    looked = asking.hint("shuffle_hash").join(others, met, "left").select(
        "qid",
        "block",
        F.when(F.col("own"), F.lit(1.0)).otherwise(F.col("x")).alias("x"),
        "own",
        "asked",
        F.when(F.col("own"), F.col("asked")).otherwise(F.col("doc_ids")).alias("doc_ids"),
        F.when(F.col("own"), F.col("found")).otherwise(F.col("parts")).alias("parts"),
    )
    looked = _unfolded(looked, "own", "asked").where(F.col("own") | F.array_contains("asked", F.col("doc_id")))
    return looked.drop("asked")


def _scores(looked: DataFrame) -> DataFrame:
    return looked.groupBy("qid", "block", "doc_id").agg(F.sum("part").alias("part"))


def _best(scored: DataFrame, k: int) -> DataFrame:
    """``(qid, rank, doc_id, probability)`` of the ``k`` best."""
    best = Window.partitionBy("qid").orderBy(F.desc("probability"), "doc_id")
    rounded = scored.select("qid", "doc_id", F.round("part", SCORE_DIGITS).alias("probability"))
    ranked = rounded.where(F.col("probability") > 0).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("qid", "rank", "doc_id", "probability")


def search_blocks(
    built: BlockIndex, queries: DataFrame, k: int = 10, limit: int = BROADCAST_BYTES, report: dict | None = None
) -> DataFrame:
    """``(qid, rank, doc_id, probability)``: the ``k`` best documents of every query, as ``search_top_k`` finds.

    ``report``, if given, is filled with the numbers of rows that were formed: ``bounds`` of a query's
    term in a block, ``blocks`` in reach of the floor of all ``met``, and ``postings`` unfolded.
    """
    index = Index(built.lists, built.stats, built.n_docs)
    idf = smooth_idf(built.n_docs, F.col("df"))
    with dealt_once(queries.sparkSession):
        # Queries of the same id are one: their weights add up.
        vectors = query_vectors(index, queries, limit).where("qid IS NOT NULL").groupBy("qid", "term").agg(
            F.sum(F.col("qw") * idf).alias("x"), F.sum("df").alias("df")
        )
        vectors = materialize(vectors, "query-weights")
        pairs = vectors.agg(F.sum("df")).first()[0] or 0
        tasks = max(queries.sparkSession.sparkContext.defaultParallelism, -(-pairs // PAIRS_PER_TASK))
        vectors = vectors.select("qid", "term", "x")
        small = fits_broadcast(vectors, limit)
        met = _met(built, vectors, small, limit)
        reach = met.groupBy("qid", "block").agg(F.sum("gain").alias("most"))
        seeds = max(2, -(-SEED_DOCS * k // built.docs_per_block))
        order = Window.partitionBy("qid").orderBy(F.desc("most"), "block")
        seeded = reach.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= seeds)
        first = materialize(seeded.select("qid", "block"), "seed-blocks")
        seen = _together(_met(built, vectors, small, limit, "doc_ids", "parts"), first, limit)
        sums = _unfolded(seen).groupBy("qid", "block", "doc_id").agg(F.sum("part").alias("part"))
        scored = materialize(sums.select("qid", "doc_id", "part"), "seed-scores")
        floors = materialize(_kth(scored, k), "floors")
        floors = F.broadcast(floors) if fits_broadcast(floors, limit) else floors

        # The lists of the asked terms are dealt out once. All of the rest is done where they arrive.
        dealt = _met(built, vectors, small, limit, tasks=tasks)
        wide = _met(built, vectors, small, limit, "doc_ids", "parts", tasks=tasks)
        cuts = _cuts(dealt, F.broadcast(first) if fits_broadcast(first, limit) else first, floors)
        entries = _entries(wide, cuts)
        looked = _looked_up(_hopeful(entries), wide)
        if report is not None:
            unfolded = [rows.agg(F.sum(F.size("parts"))).first()[0] or 0 for rows in (seen, entries)]
            report |= {
                "bounds": met.count(),
                "met": reach.count(),
                "blocks": cuts.count() + first.count(),
                "postings": sum(unfolded) + looked.where(~F.col("own")).count(),
            }
        left = materialize(_best(_scores(looked), k).select("qid", "doc_id", F.col("probability").alias("part")), "best-of-rest")
    return _best(scored.unionByName(left), k)
