"""Nearest neighbours by a block matrix join with int8 product tiles.

A vector is kept as int8 codes, the size of one code step, and the length of what the codes
leave out. Tiles of code products are exact whole numbers; with the lengths of what is left out
they bound every inner product from both sides. Pairs whose upper bound reaches a query's floor are
recomputed from the original vectors, and heaps of the best pairs go from tile to tile. The floor
is proven, so the neighbours found are the nearest ones.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from textloom.llm import grid
from textloom.session import materialize

K = 20
CODE = 127
TILE_QUERIES = 256
PAIRS = 1 << 15  # recomputed at a time
# Sums of products in doubles stray from the true product by less than this share of both lengths.
ROUNDING = 1e-11

NAMES = ("ids", "values", "codes", "step", "left")
FOUND = "query_id long, vec_id long, score double"


def quantized(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, step and a bound on the length of ``v - step * codes``, row by row."""
    with np.errstate(over="ignore", invalid="ignore", under="ignore"):
        step = np.abs(v).max(axis=1, initial=0) / CODE
        step[step < 1e-290] = 0.0
        codes = np.rint(v / np.where(step > 0, step, 1)[:, None]) * (step > 0)[:, None]
        rest = v - step[:, None] * codes
        # Rounding in the difference itself is a share of the components.
        left = np.sqrt((rest * rest).sum(axis=1)) + 1e-14 * np.sqrt((v * v).sum(axis=1)) + 1e-150
    return codes.astype(np.int8), step, left


def _columns(rows: list[dict], v: np.ndarray) -> dict[str, np.ndarray]:
    codes, step, left = quantized(v)
    return {"ids": np.array([row["vec_id"] for row in rows], "<i8"), "values": v, "codes": codes, "step": step, "left": left}


class Side:
    """A block, opened."""

    def __init__(self, block: dict):
        n, dims = block["n"], block["dims"]
        self.ids = np.frombuffer(block["ids"], "<i8")
        self.values = np.frombuffer(block["values"]).reshape(n, dims)
        self.codes = np.frombuffer(block["codes"], np.int8).reshape(n, dims)
        self.step, self.left = np.frombuffer(block["step"]), np.frombuffer(block["left"])
        with np.errstate(over="ignore"):
            self.length = np.sqrt((self.values * self.values).sum(axis=1))


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The tile of whole-number products of two sets of codes, each of them exact."""
    exact = np.float32 if CODE * CODE * q.shape[1] < 2**24 else np.float64
    return (q.astype(exact) @ c.astype(exact).T).astype(np.float64)


def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of matching rows, added up component by component from the first to the last."""
    total = np.zeros(len(q))
    with np.errstate(over="ignore", invalid="ignore"):
        for products_of_one in (q * c).T:
            total += products_of_one
    # Opposite infinities make no number: such a pair comes last. And there is one zero only.
    return np.where(np.isnan(total), -np.inf, total) + 0.0


class Nearest:
    """The k best candidates of a cell's queries."""

    def __init__(self, k: int):
        self.k, self.sides, self.heaps = k, [], []

    def ask(self, block: dict) -> None:
        self.sides.append(Side(block))
        self.heaps.append([[] for _ in range(block["n"])])

    def meet(self, block: dict) -> None:
        held = Side(block)
        for side, heaps in zip(self.sides, self.heaps):
            for low in range(0, len(side.ids), TILE_QUERIES):
                self._tile(side, slice(low, low + TILE_QUERIES), heaps[low : low + TILE_QUERIES], held)

    def _tile(self, side: Side, part: slice, heaps: list[list], held: Side) -> None:
        k = self.k
        ids, values, length = side.ids[part], side.values[part], side.length[part]
        with np.errstate(over="ignore", invalid="ignore"):
            near = products(side.codes[part], held.codes) * side.step[part][:, None] * held.step[None, :]
            # q.c - q'.c' = q.(c - c') + (q - q').c', and c' is no longer than c and what is left of it.
            reach = length[:, None] * (held.left + ROUNDING * held.length)[None, :]
            reach += side.left[part][:, None] * (held.length + held.left)[None, :]
            least, most = near - reach, near + reach
        order = np.argsort(held.ids)
        at = order[np.minimum(np.searchsorted(held.ids, ids, sorter=order), len(order) - 1)]
        own = np.flatnonzero(held.ids[at] == ids)
        least[own, at[own]] = -np.inf
        least[np.isnan(least)] = -np.inf
        floor = np.array([heap[0][0] if len(heap) == k else -np.inf for heap in heaps])
        if least.shape[1] >= k:
            floor = np.maximum(floor, np.partition(least, least.shape[1] - k, axis=1)[:, least.shape[1] - k])
        hopeful = ~(most < floor[:, None])
        hopeful[own, at[own]] = False
        rows, columns = np.nonzero(hopeful)
        for low in range(0, len(rows), PAIRS):
            at_q, at_c = rows[low : low + PAIRS], columns[low : low + PAIRS]
            self._merge(heaps, at_q, held.ids[at_c], scores(values[at_q], held.values[at_c]))

    def _merge(self, heaps: list[list], rows: np.ndarray, ids: np.ndarray, found: np.ndarray) -> None:
        order = np.lexsort((ids, -found, rows))
        rows, ids, found = rows[order], ids[order], found[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = place < self.k
        for row, number, score in zip(rows[kept].tolist(), ids[kept].tolist(), found[kept].tolist()):
            heap = heaps[row]
            if len(heap) < self.k:
                heapq.heappush(heap, (score, -number))
            elif (score, -number) > heap[0]:
                heapq.heapreplace(heap, (score, -number))

    def result(self) -> Iterator[pa.RecordBatch]:
        for side, heaps in zip(self.sides, self.heaps):
            rows = [(q, -minus, score) for q, heap in zip(side.ids.tolist(), heaps) for score, minus in heap]
            if rows:
                q, c, s = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q, pa.int64()), pa.array(c, pa.int64()), pa.array(s, pa.float64())], ["query_id", "vec_id", "score"]
                )


def nearest(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k candidates of the largest inner product for each query.

    ``vectors(vec_id, embedding, ...)``; rows that ``is_query`` (over ``vec_id``) holds for are the queries,
    all rows but the query's own are candidates. ``score`` is the product in doubles, added up from
    the first component to the last; one beyond the doubles is infinite, and one of opposite
    infinities comes last. Ties go to the smaller id; a query with fewer than k candidates gets all of
    them. Vectors null, zero, or with null or non-finite components, and null ids, take no part. Vectors of
    different lengths do not meet. Of rows that repeat an id the least vector counts. No query or no
    candidate gives no rows. Other columns are not looked at.

    Work is queries x candidates in int8; a cell gives at most k rows per query.
    """
    used = grid.doubles(vectors.select("vec_id", "embedding")).where(F.exists("v", lambda x: x != 0))
    used = grid.one_per_id(materialize(used, "vectors"))
    held = grid.blocks(used, _columns, NAMES, "candidate-blocks")
    asked = grid.blocks(used.where(is_query), _columns, NAMES, "query-blocks")
    found = materialize(grid.cells(asked, held, partial(Nearest, k), FOUND), "cell-results")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
