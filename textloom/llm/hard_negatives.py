"""Hard negatives from lists that the anchors of a cluster share.

Anchors are clustered by direction. For a cluster, candidates are sorted once by the largest product that
its geometry allows any member of unit length: the candidate's length times the cosine of its angle to
the centre less the widest angle of a member. Each member walks this list and stops, certified, where
the bound times its own length is below everything it could still take. A first walk finds an
anchor's positives, a second one the negatives in each positive's window.

Components are whole numbers and so are products; where doubles could round them, the same steps run
on Python's whole numbers. A product beyond a long counts as the nearest long.
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
from textloom.llm.grid import LONG
from textloom.session import materialize

POSITIVES = 5
NEGATIVES = 5
PERCENT = 80  # of the positive's score that a negative must reach
SCALE = 256.0
SAMPLE = 4096  # anchors that centres are fitted on, at most
MEMBERS = 16  # of the sample for each centre
FIT_ROUNDS = 8
STEP = 2048  # entries of a list walked at a time
QUERY_ROWS = 1024
# Angles come from cosines that are right to 16 digits, so they are right to 8 near 0.
SLACK = 1e-7
EXACT = 2.0**53

_ASKED = ("ids", "labels", "clusters", "values", "limits", "n_limits")
_HELD = ("ids", "labels", "values")
_POSITIVE = "anchor_id long, vec_id long, score long"
_NEGATIVE = "anchor_id long, positive_score long, vec_id long, score long"


def _unit(v: np.ndarray) -> np.ndarray:
    # Scaled first: squares of large components leave the doubles.
    most = np.abs(v).max(axis=1, initial=0)
    v = v / np.where(most > 0, most, 1)[:, None]
    length = np.sqrt((v * v).sum(axis=1))
    return v / np.where(length > 0, length, 1)[:, None]


def centres(anchors: DataFrame, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Directions around which anchors cluster, by length of vector: spherical k-means on the at most
    ``sample`` anchors whose ids have the least hashes. They order the work and change no result."""
    rows = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()
    by_length: dict[int, list] = {}
    for row in rows:
        by_length.setdefault(len(row["v"]), []).append(row["v"])
    fitted = {}
    for dims, vectors in by_length.items():
        unit = _unit(np.array(vectors, np.float64).reshape(len(vectors), dims))
        chosen = unit[:: MEMBERS].copy()
        for _ in range(FIT_ROUNDS):
            nearest = np.argmax(unit @ chosen.T, axis=1)
            total = np.zeros_like(chosen)
            np.add.at(total, nearest, unit)
            some = np.bincount(nearest, minlength=len(chosen)) > 0
            chosen[some] = _unit(total[some])
        fitted[dims] = chosen
    return fitted


def _assign(batches: Iterator[pa.RecordBatch], fitted: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for v in batch.column("v").to_pylist():
            own = fitted.get(len(v))
            found.append(0 if own is None else int(np.argmax(own @ _unit(np.array([v], np.float64).reshape(1, -1))[0])))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], [*batch.schema.names, "cluster"])


def _held_columns(rows: list[dict], v: np.ndarray) -> dict[str, np.ndarray]:
    ids, labels = (np.array([row[name] for row in rows], "<i8") for name in ("vec_id", "label"))
    return {"ids": ids, "labels": labels, "values": v}


def _asked_columns(rows: list[dict], v: np.ndarray) -> dict[str, np.ndarray]:
    limits = [row.get("limits") or [] for row in rows]
    return _held_columns(rows, v) | {
        "clusters": np.array([row["cluster"] for row in rows], "<i8"),
        "limits": np.array([score for own in limits for score in own], "<i8"),
        "n_limits": np.array([len(own) for own in limits], "<i8"),
    }


class Taker:
    """The ``k`` best of the candidates a member may take: at most ``high``, at least ``low``."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high, self.heap = k, low, high, []

    def floor(self) -> float:
        """No candidate with a lower score is taken any more."""
        if len(self.heap) == self.k:
            return self.heap[0][0]
        return -np.inf if self.low is None else self.low

    def take(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fits = scores >= self.floor()
        if self.high is not None:
            fits &= scores <= self.high
        at = np.flatnonzero(fits)
        if len(at) > self.k:
            least = np.sort(scores[at])[len(at) - self.k]
            at = at[scores[at] >= least]
            at = at[np.lexsort((ids[at], -scores[at]))[: self.k]]
        for number, score in zip(ids[at].tolist(), scores[at].tolist()):
            entry = (int(score), -number)
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)


def window(positive: int, percent: int = PERCENT) -> tuple[int, int]:
    """The scores s with percent * positive <= 100 * s <= 100 * positive."""
    return -((-percent * positive) // 100), positive


class Walk:
    """A cell: the members of some clusters, and what each of them has taken so far."""

    def __init__(self, k: int, same_label: bool, percent: int = PERCENT):
        self.k, self.same, self.percent = k, same_label, percent
        self.ids, self.labels, self.clusters, self.values, self.takers = [], [], [], [], []
        self.members: list[tuple] | None = None

    def ask(self, block: dict) -> None:
        n, dims = block["n"], block["dims"]
        for store, name in ((self.ids, "ids"), (self.labels, "labels"), (self.clusters, "clusters")):
            store.append(np.frombuffer(block[name], "<i8"))
        self.values.append(np.frombuffer(block["values"]).reshape(n, dims))
        if self.same:
            self.takers += [[Taker(self.k)] for _ in range(n)]
            return
        limits, at = np.frombuffer(block["limits"], "<i8").tolist(), 0
        for count in np.frombuffer(block["n_limits"], "<i8").tolist():
            windows = [window(positive, self.percent) for positive in limits[at : at + count]]
            # Below zero the window is empty.
            self.takers.append([Taker(self.k, low, high) for low, high in windows if low <= high])
            at += count

    def _clusters(self) -> list[tuple]:
        """Of each cluster: its members, their lengths, its centre and the widest angle of a member."""
        self.ids, self.labels, self.clusters, self.values = map(
            np.concatenate, (self.ids, self.labels, self.clusters, self.values)
        )
        found = []
        for cluster in np.unique(self.clusters):
            members = np.flatnonzero(self.clusters == cluster)
            values = self.values[members]
            unit = _unit(values)
            centre = _unit(unit.sum(axis=0, keepdims=True))[0]
            cosines = np.clip(unit @ centre, -1, 1)
            # Members of length 0 have products of 0 with everything, and no angle.
            cosines = cosines[np.abs(values).max(axis=1, initial=0) > 0]
            found.append((members, centre, np.arccos(cosines.min(initial=1))))
        return found

    def meet(self, block: dict) -> None:
        if self.members is None:
            self.members = self._clusters()
        n, dims = block["n"], block["dims"]
        ids, labels = np.frombuffer(block["ids"], "<i8"), np.frombuffer(block["labels"], "<i8")
        values = np.frombuffer(block["values"]).reshape(n, dims)
        most = float(np.abs(values).max(initial=0)), float(np.abs(self.values).max(initial=0))
        exact = 100 * most[0] * most[1] * max(dims, 1) < EXACT
        lengths = np.sqrt((values * values).sum(axis=1)) if exact else None
        unit = _unit(values)
        own = self.values if exact else self.values.astype(object)
        if not exact:
            whole = np.frompyfunc(int, 1, 1)
            own, values = whole(own).reshape(own.shape), whole(values.astype(object)).reshape(values.shape)
        for members, centre, widest in self.members:
            if not exact:
                # Bounds would leave the doubles: the list is walked to its end.
                self._walk(members, own, None, np.arange(n), None, ids, labels, values)
                continue
            angles = np.arccos(np.clip(unit @ centre, -1, 1))
            bounds = lengths * (np.cos(np.maximum(0, angles - widest)) + SLACK)
            order = np.argsort(-bounds, kind="stable")
            length = np.sqrt((own[members] * own[members]).sum(axis=1))
            self._walk(members, own, length, order, bounds[order], ids[order], labels[order], values[order])

    def _walk(self, members, own, length, order, bounds, ids, labels, values) -> None:
        active = np.arange(len(members))
        for low in range(0, len(order), STEP):
            if bounds is not None:
                floors = np.array([min((t.floor() for t in self.takers[m]), default=np.inf) for m in members[active]])
                active = active[length[active] * bounds[low] * (1 + 1e-12) >= floors]
            if not len(active):
                return
            part = slice(low, low + STEP)
            products = own[members[active]] @ values[part].T
            if bounds is None:
                products = np.array([[min(max(p, LONG.min), LONG.max) for p in row] for row in products], object)
            for member, scores in zip(members[active].tolist(), products):
                fits = labels[part] == self.labels[member]
                fits = fits & (ids[part] != self.ids[member]) if self.same else ~fits
                at = np.flatnonzero(fits)
                for taker in self.takers[member]:
                    taker.take(ids[part][at], scores[at])

    def result(self) -> Iterator[pa.RecordBatch]:
        if self.members is None:
            return
        rows = []
        for anchor, takers in zip(self.ids.tolist(), self.takers):
            for taker in takers:
                positive = () if self.same else (taker.high,)
                rows += [(anchor, *positive, -minus, score) for score, minus in taker.heap]
        names = ["anchor_id", "vec_id", "score"] if self.same else ["anchor_id", "positive_score", "vec_id", "score"]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*rows)], names)


def _first(found: DataFrame, of: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*of).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mined(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: int = PERCENT,
    scale: float = SCALE,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: for each anchor and
    each of its ``positives`` best rows of the same label, the first ``negatives`` rows of another label with a score of
    ``percent`` to 100 % of the positive's.

    ``vectors(vec_id, label, embedding, ...)``; rows that ``is_anchor`` (over ``vec_id``) holds for are anchors, all rows
    are candidates. A score is the product of the vectors with components floor(scale * x), the nearest long
    where it is beyond one; higher ones come first, ties by smaller id. An anchor without another row
    of its label, or a positive without a row in its window (so each with a score below 0), gives no rows. Rows with a null label or
    id, or a vector null or with null or non-finite components, take no part. Vectors of different lengths do
    not meet. Of rows that repeat an id the least one counts, by label, then vector. No row gives no
    row. Other columns are not looked at.

    Centres are fitted on at most 4,096 anchors; everything else covers all rows. A cell gives at most
    ``positives``, or ``positives * negatives``, rows for each anchor.
    """
    used = grid.doubles(vectors.select("vec_id", "embedding", F.col("label").cast("long").alias("label")), "label")
    used = used.where("label IS NOT NULL").select("vec_id", "label", grid.floored("v", scale).alias("v"))
    used = grid.one_per_id(materialize(used, "labelled-vectors"))
    held = grid.blocks(used, _held_columns, _HELD, "candidate-blocks")
    anchors = used.where(is_anchor)
    schema = "vec_id long, label long, v array<double>, cluster int"
    anchors = materialize(anchors.mapInArrow(partial(_assign, fitted=centres(anchors)), schema), "anchors")

    def asked(rows: DataFrame, label: str) -> DataFrame:
        # Members of a cluster side by side, in as many blocks as cells hold.
        dealt = rows.repartitionByRange("cluster", "vec_id").sortWithinPartitions("cluster", "vec_id")
        return grid.blocks(dealt, _asked_columns, _ASKED, label, QUERY_ROWS)

    walked = grid.cells(asked(anchors, "anchor-blocks"), held, partial(Walk, positives, True), _POSITIVE)
    best = materialize(_first(materialize(walked, "walked-positives"), ["anchor_id"], positives), "positives")
    limits = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_set("score")).alias("limits"))
    limited = materialize(anchors.join(limits, "vec_id"), "limited-anchors")
    walked = grid.cells(
        asked(limited, "limited-blocks"), held, partial(Walk, negatives, False, percent), _NEGATIVE
    )
    found = _first(materialize(walked, "walked-negatives"), ["anchor_id", "positive_score"], negatives)
    pairs = best.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(found, ["anchor_id", "positive_score"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
