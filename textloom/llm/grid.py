"""Blocks of vectors, and a grid of cells in which every block of queries meets every block of candidates.

A cell is a run of query blocks and a run of candidate blocks. Its task holds the queries and takes
the candidate blocks one after the other, so what it has found so far bounds what it still
looks for. Each block travels once per cell it is in, and no block meets another in a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from textloom.operators.joins import fits_broadcast
from textloom.session import materialize

BLOCK_ROWS = 8192
BLOCK_BYTES = 4 << 20
QUERY_BLOCKS = 16  # held by a cell
CANDIDATE_BLOCKS = 1024  # that pass through a cell
CELLS_PER_CORE = 2
WHOLE = 2.0**52  # from here on every double is a whole number
LONG = np.iinfo(np.int64)

_HEAD = "part int, seq long, dims int, n int"


class Cell(Protocol):
    """What a cell does: it is asked its query blocks first, then meets its candidate blocks."""

    def ask(self, block: dict) -> None: ...

    def meet(self, block: dict) -> None: ...

    def result(self) -> Iterator[pa.RecordBatch]: ...


def doubles(vectors: DataFrame, *kept: str) -> DataFrame:
    """``(vec_id, v, ...)``: components as doubles. Vectors that are null or hold null or non-finite
    components take no part, nor do null ids."""
    x = F.transform(F.col("embedding"), lambda c: c.cast("double"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("v"), *kept).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False))
    )


def floored(v: str, scale: float) -> Column:
    """Each component x as floor(scale * x), a whole number in a double of any magnitude; one that
    leaves the doubles takes their largest value."""
    most = float(np.finfo(np.float64).max)

    def floor(x: Column) -> Column:
        y = F.greatest(F.least(x * F.lit(float(scale)), F.lit(most)), F.lit(-most))
        return F.when(F.abs(y) < WHOLE, F.floor(y).cast("double")).otherwise(y)

    return F.transform(F.col(v), floor)


def one_per_id(rows: DataFrame) -> DataFrame:
    """``rows`` with each ``vec_id`` once. Of several rows the least one stays, in column order; without
    repeated ids nothing but the ids is shuffled. ``rows`` are written already."""
    ids = rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("_n"))
    if ids.where("_n > 1").isEmpty():
        return rows
    others = [name for name in rows.columns if name != "vec_id"]
    least = rows.groupBy("vec_id").agg(F.min(F.struct(*others)).alias("_row"))
    return materialize(least.select("vec_id", *[F.col(f"_row.{name}").alias(name) for name in others]), "one-per-id")


def _pack(batches: Iterator[pa.RecordBatch], columns: Callable, names: tuple[str, ...], size: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    waiting: dict[int, list[dict]] = {}
    made: dict[int, int] = {}
    part = TaskContext.get().partitionId()

    def block(dims: int) -> pa.RecordBatch:
        rows = waiting.pop(dims)
        seq = made[dims] = made.get(dims, -1) + 1
        v = np.array([row["v"] for row in rows], np.float64).reshape(len(rows), dims)
        data = columns(rows, v)
        head = [pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([dims], pa.int32()), pa.array([len(rows)], pa.int32())]
        return pa.RecordBatch.from_arrays(
            [*head, *[pa.array([data[name].tobytes()], pa.binary()) for name in names]],
            ["part", "seq", "dims", "n", *names],
        )

    for batch in batches:
        for row in batch.to_pylist():
            rows = waiting.setdefault(len(row["v"]), [])
            rows.append(row)
            if len(rows) >= max(1, min(size, BLOCK_BYTES // (8 * max(1, len(row["v"]))))):
                yield block(len(row["v"]))
    for dims in list(waiting):
        yield block(dims)


def blocks(rows: DataFrame, columns: Callable, names: tuple[str, ...], label: str, size: int = BLOCK_ROWS) -> DataFrame:
    """``rows(v, ...)`` as written blocks of up to ``size`` vectors of one length: ``(dims, number, n, ...)``.

    ``columns(rows, v)`` makes the arrays ``names`` of a block. Blocks of one length are numbered from
    0 in the order of partitions; only their numbers per partition are summed up.
    """
    schema = ", ".join([_HEAD, *[f"{name} binary" for name in names]])
    written = materialize(rows.mapInArrow(partial(_pack, columns=columns, names=names, size=size), schema), label)
    sizes = written.groupBy("dims", "part").agg(F.count(F.lit(1)).alias("blocks"))
    earlier = Window.partitionBy("dims").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shifts = materialize(
        sizes.select("dims", "part", (F.sum("blocks").over(earlier) - F.col("blocks")).alias("shift")), f"{label}-shifts"
    )
    shifts = F.broadcast(shifts) if fits_broadcast(shifts) else shifts
    return written.join(shifts, ["dims", "part"]).select(
        "dims", (F.col("seq") + F.col("shift")).alias("number"), "n", *names
    )


def _stream(batches: Iterator[pa.RecordBatch], open_cell: Callable[[], Cell]) -> Iterator[pa.RecordBatch]:
    key, cell = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            block = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            own = block["dims"], block["line"], block["strip"]
            if own != key:
                if cell is not None:
                    yield from cell.result()
                key, cell = own, open_cell()
            (cell.ask if block["side"] == 0 else cell.meet)(block)
    if cell is not None:
        yield from cell.result()


def cells(
    asked: DataFrame,
    held: DataFrame,
    open_cell: Callable[[], Cell],
    schema: str,
    query_blocks: int = QUERY_BLOCKS,
    candidate_blocks: int = CANDIDATE_BLOCKS,
) -> DataFrame:
    """What the cells of the grid of ``asked`` and ``held`` blocks give, as rows of ``schema``.

    Query blocks form lines of ``query_blocks``, candidate blocks strips of at most ``candidate_blocks``, or
    fewer as long as there are not two cells for each core. Blocks of different lengths do not meet.
    """
    spark = asked.sparkSession
    lines = asked.groupBy("dims").agg(F.count(F.lit(1)).alias("a"))
    strips = held.groupBy("dims").agg(F.count(F.lit(1)).alias("h"))
    wanted = CELLS_PER_CORE * spark.sparkContext.defaultParallelism
    grid = materialize(
        lines.join(strips, "dims")
        .selectExpr("dims", "h", f"(a + {query_blocks - 1}) div {query_blocks} AS lines")
        .selectExpr(
            "dims",
            "h",
            "lines",
            f"least(h, greatest((h + {candidate_blocks - 1}) div {candidate_blocks}, ({wanted} + lines - 1) div lines)) AS strips",
        ),
        "grid",
    )
    tasks = grid.agg(F.sum(F.col("lines") * F.col("strips")).alias("n")).first()["n"] or 1
    grid = F.broadcast(grid) if fits_broadcast(grid) else grid
    names = list(dict.fromkeys(name for side in (asked, held) for name in side.columns if name not in ("dims", "number", "n")))

    def dealt(side: DataFrame, which: int, line: str, strip: str) -> DataFrame:
        met = side.join(grid, "dims").selectExpr("*", f"{line} AS line").selectExpr("*", f"{strip} AS strip")
        data = [F.col(name) if name in side.columns else F.lit(None).cast("binary").alias(name) for name in names]
        return met.select(
            (F.col("line") * F.col("strips") + F.col("strip")).alias("cell"),
            "dims", "line", "strip", F.lit(which).alias("side"), "number", "n", *data,
        )

    queries = dealt(asked, 0, f"number div {query_blocks}", "explode(sequence(0L, strips - 1))")
    candidates = dealt(held, 1, "explode(sequence(0L, lines - 1))", "(number * strips) div h")
    met = queries.unionByName(candidates)
    task = F.pmod(F.col("cell") + F.col("dims"), F.lit(tasks)).cast("int")
    return (
        met.repartitionById(int(min(tasks, 1 << 20)), F.pmod(task, F.lit(1 << 20)).cast("int"))
        .sortWithinPartitions("dims", "line", "strip", "side", "number")
        .drop("cell")
        .mapInArrow(partial(_stream, open_cell=open_cell), schema)
    )
