"""Retrieval metrics over confusion counts.

``a`` relevant and found, ``b`` irrelevant but found, ``c`` relevant but missed,
``d`` irrelevant and left out. A metric with nothing to divide by is 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def precision(a: Column, b: Column) -> Column:
    return _ratio(a, a + b)


def recall(a: Column, c: Column) -> Column:
    return _ratio(a, a + c)


def accuracy(a: Column, b: Column, c: Column, d: Column) -> Column:
    return _ratio(a + d, a + b + c + d)


def error(a: Column, b: Column, c: Column, d: Column) -> Column:
    return _ratio(b + c, a + b + c + d)


def f_measure(p: Column, r: Column) -> Column:
    return _ratio(F.lit(2.0) * p * r, p + r)
