"""A Merkle manifest of a dataset by slot pivots.

Rows become leaves, ordered within their group. A grouping by place spreads the nodes below a
common ancestor into one column per slot by conditional aggregates; concatenating the columns of a
run hashes it, and the columns of the run without the own one are a node's siblings. One grouping
covers several levels of the tree, so its row holds whole subtrees. The same tree over the groups'
roots gives the root of the dataset. Proofs come down again from the rows that were spread: each
ancestor hands what is above it to the slots below. Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from textloom.operators.joins import fits_broadcast
from textloom.session import materialize

FANOUT = 3
LEVELS = 3  # of the tree in one grouping: its rows have FANOUT ** LEVELS slots
ROWS_PER_PART = 500_000

_STEPS = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """How a value goes into a leaf: ``-`` for null, else its length in UTF-8, a colon, itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Digest of one row's values, in lower-case hexadecimal digits like every digest here."""
    return F.sha2(F.concat(*[field(value) for value in values]), 256)


def fold(start: Column, proof: Column) -> Column:
    """The root that ``start`` leads to along ``proof``."""
    return F.aggregate(proof, start, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def siblings(proof: Column) -> Column:
    """All siblings of a proof in one string, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def seated(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with a group ``g``, never null) with the place ``pos`` of each in its group, from 0, and
    the group's size ``n``.

    Rows are ranged by group and order over partitions of bounded size and written there with their
    seats; only the number of rows per group and partition is summed up over partitions.
    """
    spark = rows.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(rows.count() / ROWS_PER_PART))
    dealt = rows.repartitionByRange(parts, "g", *order).sortWithinPartitions("g", *order)
    dealt = materialize(
        dealt.withColumns({"_part": F.spark_partition_id(), "_seat": F.monotonically_increasing_id()}), "seats"
    )
    sizes = dealt.groupBy("g", "_part").agg(F.min("_seat").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy("g")
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shifts = materialize(
        sizes.select(
            "g",
            "_part",
            (F.sum("_rows").over(earlier) - F.col("_rows") - F.col("_first")).alias("_shift"),
            F.sum("_rows").over(whole).alias("n"),
        ),
        "seat-shifts",
    )
    if fits_broadcast(shifts):
        shifts = F.broadcast(shifts)
    placed = dealt.join(shifts, ["g", "_part"]).withColumn("pos", F.col("_seat") + F.col("_shift"))
    return placed.drop("_part", "_seat", "_shift")


def _size(level: int) -> str:
    """Nodes of a group that has ``n`` of them, so many levels further up."""
    return "n" if level == 0 else f"(({_size(level - 1)} + {FANOUT - 1}) div {FANOUT})"


def _columns(level: int) -> list[str]:
    return [f"c{level}_{slot}" for slot in range(FANOUT ** (LEVELS - level))]


def _digests(level: int) -> list[str]:
    return [f"{name}.h" if level == 0 else name for name in _columns(level)]


def spread(nodes: DataFrame) -> DataFrame:
    """One row for the nodes ``(g, n, pos, node)`` below each ancestor: ``(g, n, up)``, the ``nodes`` of all
    slots, null where there is none, the digests on each level from the lowest, and the ``top`` one.

    Of ``node``, a structure, ``h`` is the digest. A group that has come down to one node
    is not hashed again: it goes up as it is. Slots are columns while they are hashed, and arrays in
    the row that is kept: a file of a hundred columns takes a hundred buffers.
    """
    width = FANOUT**LEVELS
    slots = [F.expr(f"max(CASE WHEN pos % {width} = {slot} THEN node END) AS {name}") for slot, name in enumerate(_columns(0))]
    row = nodes.groupBy("g", "n", F.expr(f"pos div {width}").alias("up")).agg(*slots)
    for level in range(LEVELS):
        below = _digests(level)
        runs = [below[at : at + FANOUT] for at in range(0, len(below), FANOUT)]
        row = row.selectExpr(
            "*",
            *[
                f"CASE WHEN {_size(level)} = 1 OR {run[0]} IS NULL THEN {run[0]} "
                f"ELSE sha2(concat_ws('', {', '.join(run)}), 256) END AS {name}"
                for name, run in zip(_columns(level + 1), runs)
            ],
        )
    levels = [f"array({', '.join(_digests(level))}) AS level{level}" for level in range(1, LEVELS)]
    return row.selectExpr("g", "n", "up", f"array({', '.join(_columns(0))}) AS nodes", *levels, f"{_columns(LEVELS)[0]} AS top")


def grow(nodes: DataFrame, label: str) -> list[DataFrame]:
    """What ``spread`` makes of the nodes ``(g, n, pos, node)``, then of the nodes it leaves, and so on,
    until every group has come down to one node; each written once, at 1/27 the rows of the one before."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    grown = []
    while not grown or most > 1:
        grown.append(materialize(spread(nodes), label))
        most = math.ceil(most / FANOUT**LEVELS)
        nodes = grown[-1].selectExpr("g", f"{_size(LEVELS)} AS n", "up AS pos", "struct(top AS h) AS node")
    return grown


def _step(level: int) -> str:
    """What is left and right of the node above ``slot`` in its run; null where there is no level."""
    at = f"(slot div {FANOUT**level})"
    return (
        f"CASE WHEN {_size(level)} > 1 THEN struct("
        f"array_join(slice(level{level}, {at} - {at} % {FANOUT} + 1, {at} % {FANOUT}), '') AS left, "
        f"array_join(slice(level{level}, {at} + 2, {FANOUT - 1} - {at} % {FANOUT}), '') AS right) END"
    )


def descend(grown: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The nodes that ``grown`` began with: ``tops``' columns, ``node`` and its whole ``proof``.

    ``tops(g, pos, proof, ...)`` has the last nodes, with what is above them. A row that was spread
    meets its ancestor's proof by ``(g, up)``, unique on both sides, and hands it to its slots.
    """
    carried = [name for name in tops.columns if name not in ("g", "pos", "proof")]
    for row in grown[::-1]:
        met = row.selectExpr("*", "nodes.h AS level0").drop("top").join(tops.withColumnRenamed("pos", "up"), ["g", "up"])
        slots = met.selectExpr("*", "posexplode(nodes) AS (slot, node)").where("node IS NOT NULL")
        steps = f"array_compact(array({', '.join(_step(level) for level in range(LEVELS))}))"
        below = slots.selectExpr(
            "g", f"up * {FANOUT**LEVELS} + slot AS pos", f"concat({steps}, proof) AS proof", *carried, "node"
        )
        tops = below.drop("node")
    return below


def prove(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves(g, h, ...)`` with ``subroot``, ``root`` and ``proof`` of each row.

    Within a group ``g`` (never null), leaves ascend by ``order``; groups ascend by ``g``. While there are
    several nodes, each run of three (the last one may be shorter) becomes the digest of their
    concatenated digests. ``proof`` is, for each level up to the root, what stands left and right
    of the node. No leaf gives no row.
    """
    names = [name for name in leaves.columns if name != "g"]
    nodes = seated(leaves, order).select("g", "n", "pos", F.struct(*names).alias("node"))
    below = grow(nodes, "group-trees")
    subroots = below[-1].select(F.lit("").alias("g"), F.col("g").alias("key"), F.col("top").alias("h"))
    groups = seated(materialize(subroots, "subroots"), ["key"])
    above = grow(groups.select("g", "n", "pos", F.struct("h", "key").alias("node")), "top-tree")
    top = above[-1].select(
        "g", F.col("up").alias("pos"), F.array().cast(_STEPS).alias("proof"), F.col("top").alias("root")
    )
    tops = descend(above, top).select(
        F.col("node.key").alias("g"), F.lit(0).cast("long").alias("pos"), "proof", F.col("node.h").alias("subroot"), "root"
    )
    return descend(below, tops).select("g", *[F.col(f"node.{name}").alias(name) for name in names], "subroot", "root", "proof")


def manifest(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof, changed)`` of every row of ``docs(doc_id, source, lang, n_chars,
    text, ...)``.

    A leaf is the digest of those five values. Leaves of one source ascend by ``doc_id``, null first,
    and those of one id by digest; sources ascend bytewise, null first. ``changed`` is the leaf
    of the same row with the text ``changed`` (the own text, unless given): what somebody else may
    have received. Repeated rows are leaves of their own. No row gives no row. Other columns are not looked at.
    """
    values = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    group = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("source")))
    leaves = materialize(
        docs.select(
            group.alias("g"),
            F.col("doc_id").cast("long").alias("doc_id"),
            leaf(*values, F.col("text")).alias("h"),
            leaf(*values, F.col("text") if changed is None else changed).alias("changed"),
            # Sets equal rows apart, so that a third of all rows being equal is no single range.
            F.monotonically_increasing_id().alias("row"),
        ),
        "leaves",
    )
    return prove(leaves, ["doc_id", "h", "row"]).select("doc_id", F.col("h").alias("leaf"), "subroot", "root", "proof", "changed")


def checked(proved: DataFrame) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``: what ``changed`` of a manifest
    leads to along the proof, and whether that is the root."""
    folded = proved.withColumn("folded_root", fold(F.col("changed"), F.col("proof")))
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def without_line_feeds() -> Column:
    """The text as tampering leaves it: without line feeds where 2 divides the checksum of the id."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(chosen, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
