"""Repeated strings by a distributed suffix sort.

A string of ``length`` bytes that starts at two places makes the suffixes there neighbours in the
sorted order of suffixes. Suffixes are dealt to buckets by sampled splitters over their leading
bytes, each bucket is sorted by a multikey quicksort, and neighbours are compared, also
across the boundaries of buckets. Beyond the leading bytes digests stand for the further
bytes: all that matters is whether neighbours are equal.

Most suffixes need not be sorted. Of every stretch of starts the place with the least hash is
its anchor, so copies of a string have theirs at the same places. An anchor speaks for a block of
neighbouring starts: its core are the bytes that all their strings share, its context the
bytes that any of them has. Cores are sorted, and contexts among equal cores:

* a core that nothing equals settles its block, as none of its strings is repeated;
* equal contexts settle theirs, as all strings in them are repeated;
* blocks with equal cores and different contexts are cut into smaller blocks at the same
  distances from the anchor and sorted again, down to single strings.

One of several equal contexts goes on with those that differ, so that these meet the strings of
all others. Equal rows of a hot string may fill many buckets, and each passes on one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from textloom.llm.exact_dedup import placed
from textloom.llm.pretokens import PIECE, gives_back, let_go
from textloom.operators.joins import fits_broadcast
from textloom.session import batches_of, materialize

LENGTH = 400
FIRST = 0.5  # share of the length that the first cores have
FINER = 8  # into how many blocks a block is cut
PER_BUCKET = 500_000
ROWS_OUT = 1 << 16

_POSITION = np.uint64((1 << 20) - 1)
_PART = 1 << 19  # starts led to anchors at once: places in it differ in the bits above
_BASE = np.uint64(0x9E3779B97F4A7C15)

SUFFIX = "lead long, rest long, context long, doc_id long, place long, low long, high long"
_SORTED = (
    "doc_id long, place long, low long, high long, same boolean, open boolean, "
    "edge int, bucket int, lead long, rest long, context long"
)


def _raw(docs: DataFrame, *kept: str) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("raw"),
        *kept,
    )


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(size, _BASE), np.full(size, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64)


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes that start at each place."""
    size = 1 << max(12, int(len(raw)).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_byte_values()[raw] * up[: len(raw)], out=sums[1:])
    hashes = (sums[gram:] - sums[:-gram]) * down[: len(raw) - gram + 1]
    hashes ^= hashes >> np.uint64(31)
    return hashes * np.uint64(0xD6E8FEB86659FD93)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, from running minima of blocks of that width."""
    if width == 1:
        return values
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def anchors(raw: np.ndarray, low: int, high: int, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the starts from ``low`` to ``high``: the anchors their strings have, and the first and
    last start of each. Starts of one anchor are neighbours."""
    hashes = gram_hashes(raw[low : high + length], gram)
    places = np.arange(len(hashes), dtype=np.uint64)
    least = window_minima((hashes & ~_POSITION) | (places & _POSITION), length - gram + 1)
    starts = np.arange(len(least), dtype=np.int64)
    chosen = starts + (((least & _POSITION).astype(np.int64) - starts) & int(_POSITION))
    first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    last = np.concatenate((first[1:], [len(chosen)])) - 1
    return chosen[first] + low, first + low, last + low


def _led(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors of all starts of a text, and the first and last start of each."""
    last = len(raw) - length
    parts = [
        anchors(raw, low, min(last, low + _PART - 1), length, gram) for low in range(0, last + 1, _PART)
    ]
    return tuple(np.concatenate(columns) for columns in zip(*parts))


def _blocks(
    place: np.ndarray, low: np.ndarray, high: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The starts from ``low`` to ``high`` before each place, cut into blocks that end at multiples
    of ``width`` before it: the end of each block, each once, with its first and last start."""
    nearest = (place - high) // width
    counts = (place - low) // width - nearest + 1
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    end = np.repeat(place - nearest * width, counts) - number * width
    order = np.argsort(end, kind="stable")
    end = end[order]
    first = np.maximum(np.repeat(low, counts)[order], end - width + 1)
    last = np.minimum(np.repeat(high, counts)[order], end)
    at = np.flatnonzero(np.concatenate(([True], end[1:] != end[:-1])))
    return end[at], np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)


def _digests(strings: Iterator[bytes], person: bytes) -> np.ndarray:
    made = (hashlib.blake2b(string, digest_size=8, person=person).digest() for string in strings)
    return np.frombuffer(b"".join(made), np.int64)


def _keys(data: bytes, raw: np.ndarray, place: np.ndarray, length: int, width: int) -> list[np.ndarray]:
    """Leading bytes and digest of each core, and the digest of its context. A context ends
    with its text, and where it does so is part of its digest."""
    core = length - width + 1
    lead = np.zeros(len(place), np.uint64)
    for i in range(8):
        lead <<= np.uint64(8)
        if i < core:
            lead |= raw[place + i]
    lead ^= np.uint64(1 << 63)
    begin = np.maximum(place - width + 1, 0)
    cut = (begin - (place - width + 1)).astype(np.uint64)
    places = place.tolist()
    rest = _digests((data[a : a + core] for a in places), b"core")
    context = _digests((data[a : b + length] for a, b in zip(begin.tolist(), places)), b"context")
    return [lead.view(np.int64), rest, (context.view(np.uint64) + cut * _BASE).view(np.int64)]


def _items(batch: pa.RecordBatch, i: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The blocks still open in a document. A row that repeats an id with a shorter text may
    not have all of their starts."""
    items = batch.column("items")[i].values
    place, low, high = (items.field(name).to_numpy(zero_copy_only=False) for name in ("place", "low", "high"))
    fit = low <= last
    return place[fit], low[fit], np.minimum(high[fit], last)


@gives_back
def _suffixes(batches: Iterator[pa.RecordBatch], length: int, width: int) -> Iterator[pa.RecordBatch]:
    """The blocks of all starts, or of those that are still open, with the keys they are sorted by."""
    let_go()
    names = ["lead", "rest", "context", "doc_id", "place", "low", "high"]
    held: list[list[np.ndarray]] = []
    rows = 0
    for batch in batches:
        for i, doc in enumerate(batch.column("doc_id").to_pylist()):
            data = batch.column("raw")[i].as_py()
            last = len(data) - length
            if doc is None or last < 0:
                continue
            raw = np.frombuffer(data, np.uint8)
            opened = "items" in batch.schema.names
            place, low, high = _items(batch, i, last) if opened else _led(raw, length, length - width + 1)
            if not len(place):
                continue
            place, low, high = _blocks(place, low, high, width)
            for k in range(0, len(place), ROWS_OUT):
                part = slice(k, k + ROWS_OUT)
                keys = _keys(data, raw, place[part], length, width)
                held.append([*keys, np.full(len(keys[0]), doc, np.int64), place[part], low[part], high[part]])
                rows += len(keys[0])
                if rows >= ROWS_OUT:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)
                    held, rows = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)


def multikey_order(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of rows, and which row in it equals the one before.

    A multikey quicksort: rows are sorted by their first key, and only runs of rows that are
    equal so far go on to be sorted by the next.
    """
    order = np.argsort(columns[0], kind="stable")
    first = columns[0][order]
    equal = np.concatenate(([False], first[1:] == first[:-1]))
    for column in columns[1:]:
        inside = equal.copy()
        inside[:-1] |= equal[1:]
        rows = np.flatnonzero(inside)
        if not len(rows):
            break
        run = np.cumsum(~equal)[rows]
        order[rows] = order[rows][np.lexsort((column[order[rows]], run))]
        ordered = column[order]
        equal[1:] &= ordered[1:] == ordered[:-1]
    return order, equal


def _either_side(equal: np.ndarray) -> np.ndarray:
    """Rows that equal the one before or the one after."""
    both = equal.copy()
    both[:-1] |= equal[1:]
    return both


@gives_back
def _sort_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort one bucket; what is repeated or open comes out, and so do its first and last row."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    columns = {name: table.column(name).to_numpy() for name in table.column_names}
    order, equal = multikey_order([columns["lead"], columns["rest"], columns["context"]])
    lead, rest = columns["lead"][order], columns["rest"][order]
    core = np.concatenate(([False], (lead[1:] == lead[:-1]) & (rest[1:] == rest[:-1])))
    same, shared = _either_side(equal), _either_side(core)
    edge = np.zeros(len(order), np.int32)
    edge[0] = 1
    edge[-1] += 2  # a bucket of one row has it on both sides: 3
    # Of equal contexts one goes on, where others of its core may be here or in the next bucket.
    group = np.cumsum(~core) - 1
    several = np.bincount(group, ~equal) > 1
    several[[0, -1]] = True
    goes_on = shared & (~same | (~equal & several[group]) | (edge > 0))
    out = np.flatnonzero(same | goes_on | (edge > 0))
    inner = edge[out] == 0
    values = [pa.array(columns[name][order[out]]) for name in ("doc_id", "place", "low", "high")]
    flags = [same[out], goes_on[out], edge[out], np.full(len(out), TaskContext.get().partitionId(), np.int32)]
    keys = [pa.array(columns[name][order[out]], mask=inner) for name in ("lead", "rest", "context")]
    names = ["doc_id", "place", "low", "high", "same", "open", "edge", "bucket", "lead", "rest", "context"]
    found = pa.table([*values, *map(pa.array, flags), *keys], names)
    yield from found.to_batches(max_chunksize=ROWS_OUT)


def repeated(suffixes: DataFrame, per_bucket: int = PER_BUCKET) -> DataFrame:
    """``(doc_id, place, low, high, same, open)`` of the rows whose core another one has: ``same``
    where also the context is another's, ``open`` where smaller blocks are to be sorted.

    The splitters are sampled from all suffixes; they cut by the whole row, so a string that
    begins everywhere is spread over several buckets, and each bucket stays near its size.
    """
    spark = suffixes.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-suffixes.count() // per_bucket))
    dealt = suffixes.repartitionByRange(n, "lead", "rest", "context", "doc_id", "place")
    found = materialize(dealt.mapInArrow(_sort_bucket, _SORTED), "sorted-suffixes")
    # Two rows per bucket at most: the last of one against the first of the next.
    order = Window.orderBy("bucket", "edge")
    core, whole = F.struct("lead", "rest"), F.struct("lead", "rest", "context")

    def beside(key):
        return F.coalesce((key == F.lag(key).over(order)) | (key == F.lead(key).over(order)), F.lit(False))

    ends = found.where("edge > 0").select(
        F.col("bucket").alias("_bucket"), F.col("edge").alias("_edge"),
        beside(whole).alias("_same"), beside(core).alias("_open"),
    )
    ends = _few(materialize(ends, "bucket-ends"))
    first = found.where("edge > 0")
    met = first.join(ends, (first["bucket"] == ends["_bucket"]) & (first["edge"] == ends["_edge"]))
    columns = ["doc_id", "place", "low", "high"]
    across = met.select(*columns, F.expr("same or _same").alias("same"), F.expr("open or _open").alias("open"))
    inside = found.where("edge = 0").select(*columns, "same", "open")
    return inside.unionByName(across.where("same or open"))


def _few(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if fits_broadcast(table) else table


def _with(raw: DataFrame, per_document: DataFrame, how: str = "inner") -> DataFrame:
    return raw.join(_few(per_document), "doc_id", how)


def _gathered(found: DataFrame, name: str, *columns: str) -> DataFrame:
    """The spans of each document in one row, which no more than its text bounds."""
    return found.groupBy("doc_id").agg(F.collect_list(F.struct(*columns)).alias(name))


def repeated_starts(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, low, high)``: the starts of all repeated strings of ``length`` bytes."""
    raw = _raw(docs)
    width = length - max(1, int(FIRST * length)) + 1
    source, settled = raw, []
    while True:
        work = partial(_suffixes, length=length, width=width)
        with batches_of(docs.sparkSession, PIECE):  # of whole texts
            suffixes = materialize(source.mapInArrow(work, SUFFIX), "suffixes")
        found = repeated(suffixes)
        settled.append(found.where("same").select("doc_id", "low", "high"))
        if width == 1:
            return materialize(reduce(DataFrame.unionByName, settled), "repeated-starts")
        items = materialize(_gathered(found.where("open"), "items", "place", "low", "high"), "open-blocks")
        source, width = _with(raw, items), width // FINER or 1


@gives_back
def _runs(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Repeated starts of each document as the runs of bytes that their strings cover."""
    kind = pa.list_(pa.struct([("low", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            starts = batch.column("starts")[i].values
            low, high = (starts.field(name).to_numpy(zero_copy_only=False) for name in ("low", "high"))
            order = np.argsort(low, kind="stable")
            low, end = low[order], np.maximum.accumulate(high[order] + length)
            first = np.flatnonzero(np.concatenate(([True], low[1:] > end[:-1])))
            last = np.concatenate((first[1:], [len(low)])) - 1
            out.append([{"low": a, "end": b} for a, b in zip(low[first].tolist(), end[last].tolist())])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "runs"])


@gives_back
def _cut(batches: Iterator[pa.RecordBatch], length: int, text_out: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, gone, runs, digests, kept = [], [], [], [], []
        for data, runs_of in zip(batch.column("raw").to_pylist(), batch.column("runs").to_pylist()):
            spans = [(s["low"], min(s["end"], len(data))) for s in runs_of or () if s["low"] < len(data)]
            ends = [0, *(high for _, high in spans)]
            rest = b"".join(data[a:b] for a, b in zip(ends, [*(low for low, _ in spans), len(data)]))
            sizes.append(len(data))
            gone.append(len(data) - len(rest))
            runs.append(len(spans))
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest.decode("utf-8", "ignore") if text_out else "")
        columns = [pa.array(c, pa.int64()) for c in (sizes, gone, runs)]
        columns = [batch.column("id"), *columns, pa.array(digests, pa.string())]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if text_out:
            columns.append(pa.array(kept, pa.string()))
            names.append("kept")
        yield pa.RecordBatch.from_arrays(columns, names)


def without_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of each row of ``docs(doc_id, text,
    ...)``, and with ``with_text`` also ``kept``, the remaining bytes as text, without those of
    characters that were cut in two.

    Every byte is removed that lies in a string of ``length`` bytes which also starts
    anywhere else in the rows, as they came in. Null texts are empty; texts under ``length`` bytes
    lose nothing. A row that repeats another one is a copy like any other: both lose all. Rows are
    told apart by the numbers of ``placed``, so an id may have several texts, and a null id takes
    part as any other. No rows give none; other columns are not looked at.
    """
    rows = placed(docs.select("doc_id", "text"), "_place")
    docs = rows.select(F.col("_place").alias("doc_id"), "text", F.col("doc_id").cast("long").alias("id"))
    starts = _gathered(repeated_starts(docs, length), "starts", "low", "high")
    runs = starts.mapInArrow(partial(_runs, length=length), "doc_id long, runs array<struct<low:bigint,end:bigint>>")
    work = partial(_cut, length=length, text_out=with_text)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    texts = _raw(docs, "id")
    rows = _with(texts, materialize(runs, "removed-runs"), "left").select("id", "raw", "runs")
    return rows.mapInArrow(work, schema + (", kept string" if with_text else ""))
