"""Running positions computed in two levels, so no group is sorted in one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from textloom.session import materialize

ROWS_PER_BLOCK = 100_000


def with_blocks(df: DataFrame, order: str, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Add ``_block``: consecutive ranges of ``order`` with about ``rows_per_block`` rows each.

    The ranges are cut at sampled places, not by arithmetic on ids, so clustered, hashed and
    distant ids make equally large blocks. The result is written, which fixes them.
    """
    blocks = max(1, math.ceil(df.count() / rows_per_block))
    dealt = df.repartitionByRange(blocks, order)
    return materialize(dealt.withColumn("_block", F.spark_partition_id().cast("long")), "blocks")


def running_position(df: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """Add ``name``: the 1-based place of each row within ``keys`` by ``order``.

    ``df`` carries ``_block``. Rows are numbered inside (keys, block), a group bounded
    by the block, and shifted by the number of rows in earlier blocks; only the per-block
    counts go through the window over ``keys``.
    """
    group = [*keys, "_block"]
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_block")
    offsets = sizes.select(
        *group,
        (
            F.sum("_size").over(earlier.rowsBetween(Window.unboundedPreceding, 0))
            - F.col("_size")
        ).alias("_before"),
    )
    inside = F.row_number().over(Window.partitionBy(*group).orderBy(order))
    return (
        df.withColumn("_inside", inside)
        .join(offsets, group)
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_before", "_inside")
    )
