"""Nearest neighbours and hard negatives against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import block_join, grid, hard_negatives
from textloom.operators import joins

SCHEMA = "vec_id bigint, embedding array<double>, label int, v double, score string"
NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    """``rows``: (id, vector, label); with columns of other uses of the operators' names."""
    return spark.createDataFrame([(*row, 0.5, "x") for row in rows], SCHEMA)


def usable(vector):
    return vector is not None and all(x is not None and np.isfinite(x) for x in vector)


def product(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total + 0.0


def brute_nearest(rows, every, k):
    used = {i: v for i, v, _ in rows if i is not None and usable(v) and any(v)}
    out = []
    for q in used:
        if q % every == 0:
            found = sorted((-product(used[q], v), i) for i, v in used.items() if i != q and len(v) == len(used[q]))
            out += [(q, rank, i, -minus) for rank, (minus, i) in enumerate(found[:k], 1)]
    return sorted(out)


def brute_negatives(rows, every, scale=256.0, positives=5, negatives=5, percent=80):
    used = {i: ([int(np.floor(scale * x)) for x in v], label) for i, v, label in rows if None not in (i, label) and usable(v)}
    out = []
    for a, (own, label) in used.items():
        if a % every == 0:
            scored = [
                (-min(max(sum(x * y for x, y in zip(own, v)), -(2**63)), 2**63 - 1), i, other == label)
                for i, (v, other) in used.items()
                if i != a and len(v) == len(own)
            ]
            scored.sort()
            for minus, p, _ in [s for s in scored if s[2]][:positives]:
                fits = [s for s in scored if not s[2] and -percent * minus <= -100 * s[0] <= -100 * minus]
                out += [(a, p, rank, i, -minus, -m) for rank, (m, i, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def nearest(spark, rows, every, k=20):
    found = block_join.nearest(table(spark, rows), F.col("vec_id") % every == 0, k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(row) for row in found.collect())


def negatives(spark, rows, every, **given):
    found = hard_negatives.mined(table(spark, rows), F.col("vec_id") % every == 0, **given)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(row) for row in found.collect())


def clustered(draw, n, dims, groups=5, labels=4, spread=0.3):
    """Vectors around a few directions, many of them equal or almost so."""
    middles = [[draw.gauss(0, 1) for _ in range(dims)] for _ in range(groups)]
    rows = []
    for i in range(n):
        middle = draw.choice(middles)
        v = [round(m + draw.gauss(0, spread), draw.choice([1, 6])) for m in middle]
        rows.append((i, rows[draw.randrange(i)][1] if i and draw.random() < 0.2 else v, draw.randrange(labels)))
    return rows


@pytest.mark.parametrize("spread", [0.01, 0.3, 3.0])
def test_against_brute_force(spark, monkeypatch, spread):
    """Several blocks, lines and strips."""
    monkeypatch.setattr(grid.blocks, "__defaults__", (40,))
    monkeypatch.setattr(grid.cells, "__defaults__", (2, 3))
    monkeypatch.setattr(hard_negatives, "QUERY_ROWS", 10)
    rows = clustered(random.Random(spread), 500, 7, spread=spread)
    assert nearest(spark, rows, 4) == brute_nearest(rows, 4, 20)
    assert negatives(spark, rows, 9) == brute_negatives(rows, 9)


def test_a_third_are_one_vector(spark):
    draw = random.Random(3)
    rows = [(i, [1.0, 2.0, -3.0], i % 2) for i in range(300)]
    rows += [(300 + i, [draw.gauss(1, 2) for _ in range(3)], draw.randrange(3)) for i in range(600)]
    assert nearest(spark, rows, 50) == brute_nearest(rows, 50, 20)
    assert negatives(spark, rows, 60) == brute_negatives(rows, 60)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [0.5, 0.5], 2), (3, None, 1), (4, [1.0, None], 1), (5, [NAN, 1.0], 1), (6, [INF, 1.0], 2),
        (7, [0.0, 0.0], 1), (8, [], 2), (9, [], 2), (10, [1.0, 2.0, 3.0], 1), (11, [1.0, 2.0, 3.0], 1), (12, [3.0, 2.0, 1.0], None),
        (None, [1.0, 1.0], 1), (20, [-1.0, -0.0], 2), (21, [0.45, 0.0], 3), (30, [1e-320, 0.0], 2), (40, [2.0, 2.0, 2.0], 3),
        (10**15, [0.25, 0.25], 2), (-10, [0.9, 0.1], 1),
    ]
    assert nearest(spark, rows, 10) == brute_nearest(rows, 10, 20)
    assert negatives(spark, rows, 10) == brute_negatives(rows, 10)
    assert nearest(spark, rows * 2, 10) == brute_nearest(rows, 10, 20)
    assert negatives(spark, rows * 3, 10) == brute_negatives(rows, 10)
    assert nearest(spark, rows, 10, k=2) == brute_nearest(rows, 10, 2)
    empty = table(spark, rows).limit(0)
    assert block_join.nearest(empty, F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.mined(empty, F.col("vec_id") % 10 == 0).count() == 0
    assert nearest(spark, rows[1:2], 1) == []
    two = [(1, [1.0, 0.0], 1), (1, [0.5, 0.0], 1), (2, [1.0, 1.0], 1)]
    assert nearest(spark, two, 1) == [(1, 1, 2, 0.5), (2, 1, 1, 0.5)]


@pytest.mark.parametrize("size", [1e3, 1e8, 1e12])
def test_large_components(spark, size):
    """Whole numbers beyond what doubles tell apart, and scores beyond a long, which count as the nearest long."""
    draw = random.Random(4)
    rows = [(i, [size * draw.gauss(0, 1) for _ in range(5)], draw.randrange(2)) for i in range(60)]
    assert negatives(spark, rows, 10) == brute_negatives(rows, 10)
    assert nearest(spark, rows, 10) == brute_nearest(rows, 10, 20)


def test_bounds_hold(spark):
    """No product is outside of what codes and what they leave out allow."""
    draw = np.random.default_rng(5)
    for size in (1e-200, 1e-3, 1.0, 1e100):
        v = draw.normal(size=(200, 33)) * size
        v[::7] = np.round(v[::7] / size) * size
        codes, step, left = block_join.quantized(v)
        assert codes.min() >= -127 and codes.max() <= 127
        back = codes * step[:, None]
        assert (np.sqrt(((v - back) ** 2).sum(axis=1)) <= left).all()
    q, c = (draw.integers(-127, 128, size=(n, 1100), dtype=np.int8) for n in (3, 4))
    assert (block_join.products(q, c) == q.astype(int) @ c.astype(int).T).all()


def test_walks_end_early(spark, monkeypatch):
    """On clustered vectors most of a list is never scored."""
    scored = []
    take = hard_negatives.Taker.take

    def counted(self, ids, scores):
        scored.append(len(ids))
        take(self, ids, scores)

    monkeypatch.setattr(hard_negatives.Taker, "take", counted)
    monkeypatch.setattr(hard_negatives, "STEP", 16)
    draw = np.random.default_rng(6)
    middles = np.eye(8)
    values = np.floor(256 * (middles[np.arange(2000) % 8] + draw.normal(size=(2000, 8)) * 0.02))
    rows = [{"vec_id": i, "label": i % 8, "v": v.tolist(), "cluster": i % 8} for i, v in enumerate(values)]
    members = rows[:80]

    def block(chosen, columns):
        v = np.array([row["v"] for row in chosen])
        return {"n": len(chosen), "dims": 8} | {k: a.tobytes() for k, a in columns(chosen, v).items()}

    cell = hard_negatives.Walk(5, True)
    cell.ask(block(members, hard_negatives._asked_columns))
    cell.meet(block(rows, hard_negatives._held_columns))
    found = {}
    for batch in cell.result():
        for row in batch.to_pylist():
            found.setdefault(row["anchor_id"], []).append((-row["score"], row["vec_id"]))
    whole = values.astype(int)
    for anchor, chosen in found.items():
        others = sorted((-int(whole[anchor] @ whole[j]), j) for j in range(2000) if j != anchor and j % 8 == anchor % 8)
        assert sorted(chosen) == others[:5]
    # All same-label products would be 80 x 249.
    assert sum(scored) < 0.6 * 80 * 249


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(grid, "fits_broadcast", lambda rows: False)
    rows = clustered(random.Random(8), 200, 4)
    assert nearest(spark, rows, 10) == brute_nearest(rows, 10, 20)
    assert negatives(spark, rows, 10) == brute_negatives(rows, 10)
