"""N-gram Jaccard join by vertical partitioning.

All shingles have one global order: frequent ones last, the most frequent at the very end, hashes
otherwise. Two sets alike by 0.75 share a shingle among the first quarter (and one) of each, its
prefix. The order is cut into fragments; within a fragment the parts of all prefixes meet. Where
in two sets a common shingle stands bounds what they can share, their bitmaps bound in what they
differ, and the pairs that remain are counted exactly.

Linked documents form components, and not all pairs of a large group are ever formed: first,
in a few rounds, each document meets the centres of its groups (stars, other centres in each
round), and what is linked becomes one component. Only pairs of different components are then
joined in full, so no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from textloom.llm.pretokens import PIECE, Memo, gives_back, in_pieces, one_held
from textloom.operators.joins import fits_broadcast
from textloom.session import batches_of, discard, materialize, scratch_path

WORDS = 5
PERCENT = 75
FREQUENT = 64  # documents from which a shingle counts as frequent
FREQUENT_HELD = 1 << 17  # the most frequent ones that go to the end of the order: one megabyte
OFTEN = 4  # times in a run of documents from which a shingle is counted
COUNTED_AT_ONCE = 10_000  # documents of a run
PER_FRAGMENT = 500_000  # shingles
MEMO = 1 << 17
STARS = 2  # star centres that a document is compared with in a round
ROUNDS = 6  # of stars at most
CROSS_FRAGMENTS = 64
PAIRS_AT_ONCE = 1 << 18
BITMAP_WORDS = 8  # at least
MOST_BITMAP_WORDS = 256

_MIX = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(1 << 62)

SETS = "doc_id long, n long, sign1 long, sign2 long, prefix binary, bitmap binary"


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


@one_held
def _hashes() -> Memo:
    return Memo(word_hash, MEMO)


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes.

    A-Z count as lower case, words are what ASCII white space parts. Fewer than ``words`` words are
    one shingle together, none are no shingle.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_hashes().__getitem__, found), np.uint64, len(found))
    size = min(words, len(found))
    n = len(found) - size + 1
    mixed = np.full(n, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ hashes[k : k + n]) * _MIX
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def in_order(shingles: np.ndarray, frequent: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Places in the global order, ascending: those of ``frequent``, which is sorted, come by their ranks
    after all others, which come by their hashes."""
    places = shingles >> np.uint64(2)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
        places = np.sort(np.where(frequent[at] == shingles, ranks[at] | _LAST, places))
    return places


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """So many first shingles hold one that any set alike by ``percent`` has among its own first."""
    return n - -(-percent * n // 100) + 1


def bitmap_words(n: int) -> int:
    """A power of two that gives a set of ``n`` shingles 0.75 to 1.5 bits for each: with far fewer, the bitmaps
    of any two sets differ in about half of them, and so in less than the sets may."""
    return min(MOST_BITMAP_WORDS, max(BITMAP_WORDS, 1 << (3 * n // 256).bit_length()))


def bitmap(shingles: np.ndarray, words: int = BITMAP_WORDS) -> np.ndarray:
    """Each bit is whether an odd number of shingles fall on it. Two bitmaps differ in no more bits than
    their sets differ in shingles, as each shingle of one set alone turns one bit round. The halves of a
    bitmap, one turned round by the other, are that of half as many words."""
    odd = np.bincount((shingles & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


@gives_back
def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of several documents of a run of ``COUNTED_AT_ONCE``, with their number there. Texts come
    in smaller batches than that, so a run has its sets in memory and few of its texts."""
    sets: list[np.ndarray] = []
    for part in in_pieces(batches):
        if len(sets) >= COUNTED_AT_ONCE:
            held, sets = _joined(sets), []
            yield _counted(held)
            del held
        sets += [shingle_set(text) for text in part.column("text").to_pylist()]
    held, sets = _joined(sets), []
    yield _counted(held)


def _joined(sets: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.empty(0, np.uint64), *sets])


def _counted(held: np.ndarray) -> pa.RecordBatch:
    held.sort()  # in place: a run has millions of shingles, few of them often
    found = np.unique(held[OFTEN - 1 :][held[OFTEN - 1 :] == held[: 1 - OFTEN]])
    counts = np.searchsorted(held, found, "right") - np.searchsorted(held, found, "left")
    return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], ["shingle", "n"])


def frequent_shingles(texts: DataFrame, least: int = FREQUENT, held: int = FREQUENT_HELD) -> np.ndarray:
    """The most frequent shingles, counted over all documents, at most ``held`` of them, the rarest first.

    They only decide the order, so that passages that many documents share are met late. A result
    never depends on which shingles these are.
    """
    counts = texts.mapInArrow(_often, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "shingle").limit(held).select("shingle")
    with batches_of(texts.sparkSession, PIECE):
        rows = top.collect()
    return np.array([row["shingle"] for row in rows], np.int64).view(np.uint64)[::-1]


@gives_back
def _sets(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    ranks = np.argsort(frequent)
    frequent, ranks = frequent[ranks], ranks.astype(np.uint64)
    for batch in in_pieces(batches):
        sizes, signs, prefixes, bitmaps = [], [], [], []
        for text in batch.column("text").to_pylist():
            shingles = shingle_set(text)
            n = len(shingles)
            sizes.append(n)
            sign = xxhash.xxh3_128_digest(shingles.tobytes())
            signs.append(np.frombuffer(sign, "<i8"))
            first = in_order(shingles, frequent, ranks)[: prefix_length(n, percent)] if n else shingles
            prefixes.append(first.tobytes())
            bitmaps.append(bitmap(shingles, bitmap_words(n)).tobytes())
        signs = np.array(signs, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(sizes, pa.int64()),
                pa.array(np.ascontiguousarray(signs[:, 0])), pa.array(np.ascontiguousarray(signs[:, 1])),
                pa.array(prefixes, pa.binary()), pa.array(bitmaps, pa.binary()),
            ],
            ["doc_id", "n", "sign1", "sign2", "prefix", "bitmap"],
        )


@gives_back
def _fragments(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Prefixes cut at the fragments of the order: rows of (fragment, shingles, owners), where each owner is a
    document with its size, the rank in it of the first of its shingles here, and their number."""
    for batch in batches:
        prefixes = batch.column("prefix").to_pylist()
        places = np.frombuffer(b"".join(prefixes), np.uint64)
        each = np.array([len(p) // 8 for p in prefixes])
        docs = np.repeat(batch.column("doc_id").to_numpy(), each)
        row = np.repeat(np.arange(len(each)), each)
        sizes = np.repeat(batch.column("n").to_numpy(), each).astype(np.int32)
        ranks = np.arange(len(places)) - np.repeat(np.cumsum(each) - each, each)
        fragment = (places >> np.uint64(63 - bits)).astype(np.int64)
        order = np.argsort(fragment, kind="stable")
        fragment = fragment[order]
        cuts = np.flatnonzero(np.concatenate(([True], fragment[1:] != fragment[:-1]))) if len(fragment) else []
        ends = [*cuts[1:], len(fragment)]
        rows = []
        for a, b in zip(cuts, ends):
            inside = order[a:b]
            runs = np.flatnonzero(np.concatenate(([True], row[inside[1:]] != row[inside[:-1]])))
            lengths = np.diff(np.concatenate((runs, [len(inside)])))
            owners = np.stack((docs[inside[runs]], sizes[inside[runs]], ranks[inside[runs]], lengths))
            rows.append((int(fragment[a]), places[inside].tobytes(), owners.astype("<i8").tobytes()))
        columns = list(zip(*rows)) if rows else [(), (), ()]
        kinds = (pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["fragment", "places", "owners"]
        )


def _unfolded(places: list[bytes], owners: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles with their documents, sizes and ranks, from rows of a fragment."""
    docs, sizes, firsts, lengths = np.concatenate([np.frombuffer(o, "<i8").reshape(4, -1) for o in owners], axis=1)
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    places = np.frombuffer(b"".join(places), np.int64)
    return places, np.repeat(docs, lengths), np.repeat(sizes, lengths), np.repeat(firsts, lengths) + within


def _shared(table: pa.Table) -> pa.Table:
    """The shingles of a fragment that two documents at least hold: rows (place, doc_id, n, at)."""
    places, docs, sizes, ranks = _unfolded(*(table.column(c).to_pylist() for c in ("places", "owners")))
    order = np.lexsort((docs, places))
    ordered, owner = places[order], docs[order]
    # Rows that repeat an id hold a shingle once.
    new = np.concatenate(([True], (ordered[1:] != ordered[:-1]) | (owner[1:] != owner[:-1])))
    order, ordered = order[new], ordered[new]
    same = np.concatenate(([False], ordered[1:] == ordered[:-1]))
    same[:-1] |= same[1:]
    kept = order[same]
    return pa.table([pa.array(column[kept]) for column in (places, docs, sizes, ranks)], ["place", "doc_id", "n", "at"])


def shared_shingles(sets: DataFrame) -> DataFrame:
    """``(place, doc_id, n, at)``: each prefix shingle that several sets hold, with these sets and its rank in each.

    A fragment is a range of the order with about half a million shingles. Frequent shingles are
    known to be shared, so they need not meet: they never make a fragment large.
    """
    held = sets.agg(F.sum(F.octet_length("prefix") / 8)).first()[0] or 0
    # Prefixes lie in the first quarter of the order's unmarked half, an eighth of it all.
    bits = 5 + max(0, int(np.ceil(np.log2(max(1.0, held / PER_FRAGMENT)))))
    kind = "fragment long, places binary, owners binary"
    cut = materialize(
        sets.select("doc_id", "n", "prefix").mapInArrow(partial(_fragments, bits=bits), kind), "prefix-fragments"
    )
    common = F.col("fragment") >= (1 << (bits - 1))
    rare = cut.where(~common).groupBy("fragment").applyInArrow(_shared, "place long, doc_id long, n long, at long")
    known = cut.where(common).mapInArrow(_rows, "place long, doc_id long, n long, at long")
    return rare.unionByName(known)


def one_per_list(shared: DataFrame) -> DataFrame:
    """``(place, doc_id, n, at, weight)``: neighbouring shingles of a passage have the same documents;
    the first of them stands for all, with their number as its weight. Lists are told apart by
    their length and two hashes of their documents."""
    marks = [F.bit_xor(F.xxhash64("doc_id", F.lit(seed))).alias(f"mark{seed}") for seed in (1, 2)]
    lists = shared.groupBy("place").agg(*marks, F.count(F.lit(1)).alias("held"))
    chosen = lists.groupBy("mark1", "mark2", "held").agg(
        F.min("place").alias("place"), F.count(F.lit(1)).alias("weight")
    )
    return shared.join(_few(materialize(chosen.select("place", "weight"), "shingle-lists")), "place")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for places, owners in zip(*(batch.column(c).to_pylist() for c in ("places", "owners"))):
            columns = _unfolded([places], [owners])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["place", "doc_id", "n", "at"])


def labelled(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """``shared`` with the component of each document."""
    own = _few(labels.select(F.col("id").alias("doc_id"), "label"))
    return shared.join(own, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))


def mixed_only(own: DataFrame) -> DataFrame:
    """Shingles whose documents are of several components: one component has nothing left to find."""
    ends = own.groupBy("place").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return own.join(_few(materialize(ends.where("low != high").select("place"), "mixed-places")), "place")


def star_pairs(own: DataFrame, number: int, percent: int = PERCENT, stars: int = STARS) -> DataFrame:
    """``(a, b)``: documents ``b`` with the centres ``a`` of most of their groups (a shingle and a
    class of sizes) that are of another component. Each round has other centres and classes."""
    scale = float(np.log(100 / percent))
    sized = F.floor(F.log(F.col("n").cast("double")) / scale + F.lit(0.5 * (number % 2)))
    grouped = own.withColumn("class", sized)
    drawn = F.struct(F.xxhash64("doc_id", F.lit(number)).alias("draw"), F.col("doc_id"), F.col("label"))
    centres = grouped.groupBy("place", "class").agg(F.min(drawn).alias("centre"))
    counted = (
        grouped.join(centres, ["place", "class"])
        .where(F.col("centre.label") != F.col("label"))
        .groupBy(F.col("centre.doc_id").alias("a"), F.col("doc_id").alias("b"))
        .agg(F.sum("weight").alias("overlap"), F.first("n").alias("n"))
        # A star need not hold every link; these are the likely ones.
        .where(F.col("overlap") * 400 >= F.col("n") * (100 - percent))
    )
    best = Window.partitionBy("b").orderBy(F.desc("overlap"), "a")
    return counted.withColumn("_at", F.row_number().over(best)).where(F.col("_at") <= stars).select("a", "b")


def _by_words(bitmaps: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each number of words that a bitmap here has: all that have as many or more, folded to
    that length, and the row there of each bitmap."""
    words = np.array([len(held) // 8 for held in bitmaps])
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    above, folded = np.empty(0, np.int64), None
    for length in np.unique(words)[::-1].tolist():
        own = np.flatnonzero(words == length)
        made = np.frombuffer(b"".join(bitmaps[k] for k in own), np.uint64).reshape(len(own), length)
        if folded is not None:
            parts = folded.reshape(len(folded), -1, length) if length else folded[:, None, :0]
            made = np.concatenate((np.bitwise_xor.reduce(parts, axis=1), made))
        above, folded = np.concatenate((above, own)), made
        at = np.full(len(words), -1)
        at[above] = np.arange(len(above))
        found[length] = at, folded
    return found


def _cross(table: pa.Table, bitmaps: pa.Table, percent: int) -> pa.Table:
    """Pairs of different components that share one of a group of places and can still be alike.

    Of the shingles that two sets share, all follow their first common place in both: where it comes
    too late in one of them, what is left is too few. And sets alike by ``percent`` differ in a bounded
    number of shingles, so their bitmaps differ in no more bits.
    """
    place, docs, sizes, labels, ranks = (table.column(c).to_numpy() for c in ("place", "doc_id", "n", "label", "at"))
    by = np.lexsort((sizes, docs))
    new = np.concatenate(([True], (docs[by[1:]] != docs[by[:-1]]) | (sizes[by[1:]] != sizes[by[:-1]])))
    number = np.empty(len(by), np.int64)
    number[by] = np.cumsum(new) - 1
    each = np.lexsort((bitmaps.column("n").to_numpy(), bitmaps.column("doc_id").to_numpy()))
    held = _by_words(bitmaps.column("bitmap").take(pa.array(each)).to_pylist())
    words = np.zeros(len(each), np.int64)
    for length in sorted(held):
        words[held[length][0] >= 0] = length

    order = np.lexsort((docs, sizes, place))
    place, docs, sizes, labels, ranks, number = (x[order] for x in (place, docs, sizes, labels, ranks, number))
    group = np.cumsum(np.concatenate(([False], place[1:] != place[:-1]))) << 32
    reach = np.searchsorted(group | sizes, group | np.minimum(sizes * 100 // percent, (1 << 32) - 1), side="right")
    counts = reach - np.arange(len(place)) - 1
    ends = np.cumsum(counts)
    pairs = [np.empty((2, 0), np.int64)]
    low = 0
    while low < len(place):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, side="right")))
        times = counts[low:high]
        i = np.repeat(np.arange(low, high), times)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
        low = high
        both = sizes[i] + sizes[j]
        needed = -(-both * percent // (100 + percent))
        apart = (labels[i] != labels[j]) & (ranks[i] <= sizes[i] - needed) & (ranks[j] <= sizes[j] - needed)
        i, j, both = i[apart], j[apart], both[apart]
        at, first = np.unique(number[i] * len(each) + number[j], return_index=True)
        i, j, both = i[first], j[first], both[first]
        length = np.minimum(words[number[i]], words[number[j]])
        for size in np.unique(length).tolist():
            at, rows = held[size]
            alike = np.flatnonzero(length == size)
            step = max(1, (1 << 21) // max(1, size))
            for k in range(0, len(alike), step):
                part = alike[k : k + step]
                x, y = rows[at[number[i[part]]]], rows[at[number[j[part]]]]
                unlike = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
                part = part[unlike * (100 + percent) <= both[part] * (100 - percent)]
                a, b = docs[i[part]], docs[j[part]]
                pairs.append(np.stack((np.minimum(a, b), np.maximum(a, b))))
    a, b = np.unique(np.concatenate(pairs, axis=1), axis=1)
    return pa.table({"a": pa.array(a), "b": pa.array(b)})


def cross_pairs(mixed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(a, b)``: all pairs of different components that can still be alike, of documents
    ``(doc_id, n, label, places, bitmap)``. Places meet in groups, and a bitmap is sent once to each group
    that its document has places in."""
    held = mixed.agg(F.sum(F.size("places"))).first()[0] or 0
    fragments = max(CROSS_FRAGMENTS, 3 * held // PER_FRAGMENT)

    def fragment(place):
        return F.pmod(F.xxhash64(place), F.lit(fragments))

    def cross(table: pa.Table, bitmaps: pa.Table) -> pa.Table:
        return _cross(table, bitmaps, percent)

    rows = mixed.select("doc_id", "n", "label", F.inline("places")).withColumn("fragment", fragment("place"))
    met = F.array_distinct(F.transform("places", lambda one: fragment(one["place"])))
    bitmaps = mixed.select("doc_id", "n", "bitmap", F.explode(met).alias("fragment"))
    return rows.groupBy("fragment").cogroup(bitmaps.groupBy("fragment")).applyInArrow(cross, "a long, b long").distinct()


@gives_back
def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_pieces(batches):
        sets = [shingle_set(text).tobytes() for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "shingles"])


@gives_back
def _compare(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in in_pieces(batches):
        linked = []
        for x, y in zip(batch.column("of_a").to_pylist(), batch.column("of_b").to_pylist()):
            one, other = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            at = np.minimum(np.searchsorted(one, other), len(one) - 1)
            both = int((one[at] == other).sum())
            linked.append(100 * both >= percent * (len(one) + len(other) - both))
        yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def _few(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if fits_broadcast(table) else table


def linked(texts: DataFrame, pairs: DataFrame, label: str, percent: int = PERCENT) -> DataFrame:
    """Those of ``pairs(a, b)`` whose whole sets are alike, as a written table. The sets, which take as much
    room as the texts, are deleted as soon as it is there."""
    spark = texts.sparkSession
    ids = pairs.select(F.col("a").alias("doc_id")).distinct()
    wanted = ids.union(pairs.select(F.col("b").alias("doc_id")).distinct()).distinct()
    wanted = materialize(wanted, "compared-ids")
    kind, path = "doc_id long, shingles binary", scratch_path(spark, "whole-sets")
    with batches_of(spark, PIECE):
        texts.join(_few(wanted), "doc_id", "left_semi").mapInArrow(_whole_sets, kind).write.parquet(path)
    sets = spark.read.schema(kind).parquet(path)
    met = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b")), "b").join(
        sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a")), "a"
    )
    compared = met.select("a", "b", "of_a", "of_b").mapInArrow(partial(_compare, percent=percent), "a long, b long")
    with batches_of(spark, PIECE):  # of two sets in a row
        links = materialize(compared, label)
    discard(spark, path)
    return links


def components(edges: DataFrame) -> DataFrame:
    """``(id, label)``: the smallest id that each linked id reaches.

    Each round every id takes the least label among its neighbours' and its own, and then the label of
    its label, so paths shorten by half. Each round is written down. The neighbours of one id
    are combined before the shuffle.
    """
    both = materialize(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        least = (
            both.join(labels.select(F.col("id").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("label").alias("near"))
        )
        nearer = labels.join(least, "id").select("id", "label", F.least("label", "near").alias("near"))
        further = labels.select(F.col("id").alias("near"), F.col("label").alias("far"))
        moved = materialize(
            nearer.join(further, "near", "left").select(
                "id", F.least("near", F.coalesce("far", "near")).alias("label"), (F.col("label")).alias("before")
            ),
            "labels",
        )
        labels = moved.select("id", "label")
        if moved.where("label != before").isEmpty():
            return labels


def _edges(labels: DataFrame) -> DataFrame:
    """What components are known already, as one link of each member to the least."""
    return labels.where("id != label").select(F.col("label").alias("a"), F.col("id").alias("b"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs(doc_id, text, ...)``.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of five-word
    shingles; ``component_id`` is the smallest id reached by links. Null, empty and blank texts have
    no shingles and link with nothing. Sets that are equal are one class, compared once. Rows that
    repeat an id and text are copies of each other; rows with a null id take no part and
    have a null component. No rows give none; other columns are not looked at.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    frequent = frequent_shingles(texts.select("text"))
    with batches_of(spark, PIECE):
        sets = materialize(texts.mapInArrow(partial(_sets, frequent=frequent, percent=percent), SETS), "shingle-sets")
    known = sets.where("n > 0 and doc_id is not null")
    classes = materialize(
        known.groupBy("sign1", "sign2", "n").agg(F.min("doc_id").alias("first_id")), "set-classes"
    )
    single = _few(classes.select(F.col("first_id").alias("doc_id")))
    first = known.join(single, "doc_id", "left_semi")
    shared = materialize(one_per_list(materialize(shared_shingles(first), "shared-shingles")), "shingle-groups")

    labels = components(spark.createDataFrame([], "a bigint, b bigint"))
    for number in range(ROUNDS):
        stars = materialize(star_pairs(labelled(shared, labels), number, percent), "star-pairs")
        links = linked(texts, stars, "star-links", percent)
        if links.isEmpty():
            break
        labels = components(_edges(labels).unionByName(links))
    mixed = mixed_only(labelled(shared, labels))
    places = F.collect_list(F.struct("place", "at")).alias("places")
    mixed = materialize(mixed.groupBy("doc_id", "n", "label").agg(places), "document-places")
    met = _few(mixed.select("doc_id", "n"))
    # An id that has several texts of one size has no bitmap that holds for all.
    one = F.when(F.min("bitmap") == F.max("bitmap"), F.min("bitmap")).otherwise(F.lit(b"")).alias("bitmap")
    bitmaps = first.select("doc_id", "n", "bitmap").join(met, ["doc_id", "n"], "left_semi").groupBy("doc_id", "n").agg(one)
    mixed = materialize(mixed.join(bitmaps, ["doc_id", "n"]), "compared-documents")
    pairs = materialize(cross_pairs(mixed, percent), "cross-pairs")
    more = linked(texts, pairs, "cross-links", percent)
    labels = components(_edges(labels).unionByName(more))

    named = classes.join(
        labels.select(F.col("id").alias("first_id"), "label"), "first_id", "left"
    ).select("sign1", "sign2", "n", F.coalesce("label", "first_id").alias("component_id"))
    rows = sets.select("doc_id", "n", "sign1", "sign2")
    found = rows.join(_few(named), ["sign1", "sign2", "n"], "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
