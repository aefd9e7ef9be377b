"""Exact top-k search by columnar branch and bound.

Candidates lie in blocks, each block stored dimension by dimension. A block of queries meets a
block of candidates: scores grow by some dimensions at a time, and what the rest of the
dimensions can still add is bounded by the lengths of the two remainders. Candidates that can
no longer reach the k best of any query of the block are dropped and the columns compacted.
All of it is whole-number arithmetic on doubles, so scores are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from textloom.llm.grid import LONG, doubles, floored
from textloom.operators.joins import fits_broadcast
from textloom.session import materialize

K = 20
CANDIDATES = 4096  # per block
QUERIES = 256  # per block
DIMENSIONS = 16  # accumulated at a time
EXACT = 2.0**53

_BLOCK = "block long, n int, dims int, ids binary, columns binary"
FOUND = "query_id long, vec_id long, score long"


def whole_numbers(vectors: DataFrame, scale: float) -> DataFrame:
    """``(vec_id, v)``: each component x as floor(scale * x). Vectors that are null or hold null or
    non-finite components take no part, nor do null ids."""
    return doubles(vectors).select("vec_id", floored("v", scale).alias("v"))


def _pack(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Blocks of up to ``size`` vectors of one length, one binary column of components."""
    waiting: dict[int, tuple[list, list]] = {}

    def block(dims: int) -> pa.RecordBatch:
        ids, rows = waiting.pop(dims)
        columns = np.ascontiguousarray(np.array(rows, np.float64).reshape(len(ids), dims).T)
        values = [0], [len(ids)], [dims], [np.array(ids, "<i8").tobytes()], [columns.tobytes()]
        kinds = pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(values, kinds)], ["block", "n", "dims", "ids", "columns"]
        )

    for batch in batches:
        for number, vector in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()):
            ids, rows = waiting.setdefault(len(vector), ([], []))
            ids.append(number)
            rows.append(vector)
            if len(ids) == size:
                yield block(len(vector))
    for dims in list(waiting):
        yield block(dims)


def blocks(vectors: DataFrame, size: int, label: str) -> DataFrame:
    """``vectors(vec_id, v)`` as numbered blocks, written to the shared folder."""
    packed = vectors.mapInArrow(partial(_pack, size=size), _BLOCK)
    return materialize(packed.withColumn("block", F.monotonically_increasing_id()), label)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = np.flatnonzero(scores >= least)
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], -scores[kept]))[:k]]


def meet(
    q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, columns: np.ndarray, k: int, step: int = DIMENSIONS
) -> list[tuple[int, int, int]]:
    """The k best candidates of this block for each query: ``q`` is queries x dimensions,
    ``columns`` dimensions x candidates."""
    dims = q.shape[1]
    if float(np.abs(q).max(initial=0)) * float(np.abs(columns).max(initial=0)) * max(dims, 1) >= EXACT:
        return _meet_exactly(q_ids, q, c_ids, columns, k)
    q_rest = np.sqrt(np.cumsum((q * q)[:, ::-1], axis=1)[:, ::-1])
    c_rest = np.sqrt(np.cumsum((columns * columns)[::-1], axis=0)[::-1])
    # A first floor under each query's k-th score: true scores of the longest candidates.
    longest = np.argsort(-c_rest[0] if dims else np.zeros(len(c_ids)), kind="stable")[: 4 * k + 1]
    seed = q @ columns[:, longest]
    seed[q_ids[:, None] == c_ids[longest][None, :]] = -np.inf
    floor = np.full(len(q), -np.inf)
    if seed.shape[1] >= k:
        floor = np.partition(seed, seed.shape[1] - k, axis=1)[:, seed.shape[1] - k]
    alive, scores = np.arange(len(c_ids)), np.zeros((len(q), len(c_ids)))
    for low in range(0, dims, step):
        high = min(low + step, dims)
        scores += q[:, low:high] @ columns[low:high, alive]
        if high < dims:
            # Rounding in the square roots is far below the half that whole scores leave free.
            reach = scores + q_rest[:, high, None] * c_rest[high, alive][None, :] + 0.5
            keep = (reach >= floor[:, None]).any(axis=0)
            if keep.sum() < 0.8 * len(keep):
                alive, scores = alive[keep], np.ascontiguousarray(scores[:, keep])
    found = []
    ids = c_ids[alive]
    for number, row, least in zip(q_ids.tolist(), scores, floor):
        hopeful = np.flatnonzero((row >= least) & (ids != number))
        chosen = hopeful[best(row[hopeful], ids[hopeful], k)]
        found += [(number, i, int(s)) for i, s in zip(ids[chosen].tolist(), row[chosen])]
    return found


def _meet_exactly(q_ids, q, c_ids, columns, k):
    """Components so large that doubles would round: Python's whole numbers. A score beyond a long
    counts as the nearest long."""
    found = []
    low, high = int(LONG.min), int(LONG.max)
    rows = [[int(x) for x in column] for column in columns.T]
    for number, query in zip(q_ids.tolist(), q):
        own = [int(x) for x in query]
        scored = [
            (-min(max(sum(a * b for a, b in zip(own, row)), low), high), i)
            for i, row in zip(c_ids.tolist(), rows)
            if i != number
        ]
        found += [(number, i, -s) for s, i in sorted(scored)[:k]]
    return found


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            q = np.frombuffer(row["q_columns"]).reshape(row["dims"], row["q_n"]).T
            columns = np.frombuffer(row["columns"]).reshape(row["dims"], row["n"])
            found = meet(np.frombuffer(row["q_ids"], "<i8"), q, np.frombuffer(row["ids"], "<i8"), columns, k)
            ids, others, scores = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, pa.int64()) for values in (ids, others, scores)], ["query_id", "vec_id", "score"]
            )


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: float = 64.0) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k highest inner products of each query.

    ``vectors(vec_id, embedding, ...)``; rows that ``is_query`` (over ``vec_id``) holds for are
    the queries, all rows but the query's own are candidates. Components become
    floor(scale * x). Ties go to the smaller id; a query with fewer than k candidates gets
    all of them. Vectors of different lengths do not meet. Ids are unique; a repeated
    row counts once. A score beyond a long counts as the nearest long. Vectors null or with null or non-finite components, and null ids, take no part;
    no query or no candidate gives no rows. Other columns are not looked at.

    The number of pairs of blocks is queries x candidates over 256 x 4096: each is one row of
    about two megabytes, dealt evenly. A task gives at most k rows per query and block.
    """
    whole = whole_numbers(vectors, scale).dropDuplicates(["vec_id"])
    whole = materialize(whole, "whole-vectors")
    candidates = blocks(whole, CANDIDATES, "candidate-blocks")
    queries = blocks(whole.where(is_query).coalesce(1 + whole.rdd.getNumPartitions() // 8), QUERIES, "query-blocks")
    asked = queries.select(
        F.col("block").alias("q_block"), F.col("n").alias("q_n"), F.col("dims").alias("q_dims"),
        F.col("ids").alias("q_ids"), F.col("columns").alias("q_columns"),
    )
    # Numbers of blocks meet first; the blocks themselves follow by their numbers.
    spark = vectors.sparkSession
    per_task = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    numbers = queries.select(F.col("block").alias("q_block"), F.col("dims").alias("q_dims"))
    held = candidates.groupBy("dims").agg(F.collect_list("block").alias("blocks"))
    held = materialize(held, "block-numbers")
    held = F.broadcast(held) if fits_broadcast(held) else held
    pairs = numbers.join(held, F.col("q_dims") == F.col("dims")).select(
        "q_block", F.explode("blocks").alias("block")
    )
    met = (
        pairs.repartition(per_task, "block", "q_block")
        .join(asked, "q_block")
        .join(candidates, "block")
    )
    found = met.select("dims", "n", "ids", "columns", "q_n", "q_ids", "q_columns").mapInArrow(
        partial(_search, k=k), FOUND
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        materialize(found, "block-results")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


VECTORS = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))]
)
