"""Exact, near and substring duplicates against brute force."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from textloom.llm import exact_dedup, ngram_join, pretokens, suffix_dedup
from textloom.session import batches_of


def frame(spark, rows):
    """With columns named like the operators' own."""
    wide = [(i, text, "x", 3) for i, text in rows]
    return spark.createDataFrame(wide, "doc_id bigint, text string, kept string, label bigint")


# What a task holds


def traced_peak(work):
    tracemalloc.start()
    made = work()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return made, peak


def wordy_batch(rows):
    dice = random.Random(21)
    common = " ".join(f"c{i}" for i in range(12))
    texts = [" ".join(f"w{dice.randrange(4000)}" for _ in range(150)) + (common if i % 3 else "") for i in range(rows)]
    return pa.RecordBatch.from_pydict({"doc_id": list(range(rows)), "text": [*texts[:-1], None]})


def test_often_holds_little_besides_the_sets():
    batch = wordy_batch(6000)
    sets = [ngram_join.shingle_set(text) for text in batch.column("text").to_pylist()]
    found, peak = traced_peak(lambda: next(ngram_join._often(iter([batch]))))
    counts = Counter(int(x) for one in sets for x in one.view(np.int64))
    rows = dict(zip(found.column("shingle").to_pylist(), found.column("n").to_pylist()))
    assert rows == {x: n for x, n in counts.items() if n >= ngram_join.OFTEN} and len(rows) > 5
    assert peak < 2.7 * sum(one.nbytes for one in sets)
    assert next(ngram_join._often(iter([batch.slice(0, 0)]))).num_rows == 0


def test_often_counts_a_run_of_small_batches_as_one(monkeypatch):
    batch = wordy_batch(6000)
    parts = [batch.slice(low, 500) for low in range(0, 6000, 500)]

    def rows(made):
        return [sorted(zip(*(column.to_pylist() for column in one.columns))) for one in made]

    assert rows(ngram_join._often(iter(parts))) == rows(ngram_join._often(iter([batch])))
    monkeypatch.setattr(ngram_join, "COUNTED_AT_ONCE", 3000)
    halves = [*ngram_join._often(iter([batch.slice(0, 3000)])), *ngram_join._often(iter([batch.slice(3000)]))]
    assert rows(ngram_join._often(iter(parts))) == rows(halves)


def test_whole_sets_come_in_pieces():
    batch = wordy_batch(6000)
    sizes, peak = traced_peak(lambda: [one.num_rows for one in ngram_join._whole_sets(iter([batch]))])
    assert sum(sizes) == 6000 and max(sizes) <= pretokens.PIECE
    assert peak < 6 << 20


def test_texts_come_in_small_batches(spark, monkeypatch):
    """Tasks that cut suffixes get a thousand texts at most, and the setting is as it was afterwards."""
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", {}
    written = suffix_dedup.materialize

    def spied(df, label):
        seen.setdefault(label, int(spark.conf.get(name)))
        return written(df, label)

    monkeypatch.setattr(suffix_dedup, "materialize", spied)
    before = spark.conf.get(name)
    suffix_dedup.repeated_starts(frame(spark, [(1, "a" * 900)]))
    assert seen["suffixes"] <= pretokens.PIECE < int(before) == int(spark.conf.get(name)) == seen["sorted-suffixes"]


def test_files_of_texts_are_read_in_small_batches(spark):
    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"]
    before = [spark.conf.get(name) for name in names]
    with batches_of(spark, 10):
        assert [spark.conf.get(name) for name in names] == ["10", "10"]
    assert [spark.conf.get(name) for name in names] == before


# Exact copies


def test_exact_duplicates(spark):
    rows = [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (6, "A"), (7, "a" * 50_000), (None, "a"), (None, "c"), (9, "a")]
    found = {
        (row["doc_id"], row["text_sha256"]): (row["keep_id"], row["group_size"], row["kept"])
        for row in exact_dedup.exact_duplicates(frame(spark, rows)).collect()
    }
    digest = lambda text: hashlib.sha256((text or "").encode()).hexdigest()
    groups = Counter(text or "" for _, text in rows)
    for i, text in rows:
        ids = [j for j, other in rows if (other or "") == (text or "") and j is not None]
        keep = max(ids) if ids else None
        assert found[i, digest(text)] == (keep, groups[text or ""], i == keep)
    kept = exact_dedup.without_duplicates(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "kept", "label"]
    assert sorted(row["doc_id"] for row in kept.collect() if row["doc_id"] is not None) == [3, 5, 6, 7, 9]


def test_exact_duplicates_of_nothing(spark):
    assert exact_dedup.exact_duplicates(frame(spark, []).limit(0)).count() == 0


def test_state_goes_on_where_it_ended(spark, tmp_path):
    arriving, state = str(tmp_path / "arriving"), str(tmp_path / "state")
    for rows in ([(1, "a"), (2, "b")], [(3, "a")]):
        exact_dedup.arrivals(frame(spark, rows)).write.mode("append").parquet(arriving)
        exact_dedup.absorb(spark.readStream.schema(exact_dedup.ARRIVALS).parquet(arriving), state)
    held = sorted((row["keep_id"], row["group_size"]) for row in exact_dedup.state(spark, state).collect())
    assert held == [(2, 1), (3, 2)]


def test_equal_digests_with_other_bytes(spark):
    """Rows under one digest are compared byte by byte, in several salts."""
    rows = [(i, "same") for i in range(2500)]
    docs = frame(spark, rows)
    digest = hashlib.sha256(b"same").digest()
    hits = spark.createDataFrame([(i, digest, 2499, 2500) for i in range(2500)], "doc_id bigint, digest binary, keep_id bigint, group_size bigint")
    checked = exact_dedup.compared(docs, hits)
    assert checked.count() == 2499
    assert checked.where("not same").count() == 0


# Near copies


def sets_of(rows):
    out = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = [tuple(words[k : k + 5]) for k in range(len(words) - 4)] or ([tuple(words)] if words else [])
        out[i] = frozenset(runs)
    return out


def brute_components(rows):
    sets = sets_of([row for row in rows if row[0] is not None])
    first = {i: i for i in sets}

    def top(i):
        while first[i] != i:
            i = first[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                first[b] = a
    return {i: (len(sets[i]), top(i)) for i in ids}


@pytest.fixture(scope="module")
def near_rows():
    draw = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    passages = [draw.choices(words, k=30) for _ in range(3)]
    rows = []
    for i in range(400):
        text = draw.choices(words, k=draw.choice([0, 1, 3, 5, 7, 20, 60]))
        if draw.random() < 0.4:
            text = text[:8] + draw.choice(passages) + text[8:]
        if draw.random() < 0.6 and rows:
            text = rows[draw.randrange(len(rows))][1].split(" ")
            for _ in range(draw.choice([0, 1, 1, 2, 3])):
                text[draw.randrange(len(text))] = draw.choice(words)
        rows.append((i, draw.choice([" ".join, lambda w: "  ".join(w).upper()])(text)))
    return [*rows, (9000, None), (9001, ""), (9002, " \t\n"), (9003, "x " * 3000), (9004, "x " * 2990)]


def test_near_duplicates(spark, near_rows):
    found = ngram_join.near_duplicates(frame(spark, near_rows)).collect()
    assert {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in found} == brute_components(near_rows)
    assert len(found) == len(near_rows)


def test_order_changes_nothing(spark, near_rows, monkeypatch):
    """Which shingles count as frequent, and a single star, leave the components as they are."""
    monkeypatch.setattr(ngram_join, "STARS", 1)
    import numpy as np

    some = np.unique(np.concatenate([ngram_join.shingle_set(text) for _, text in near_rows[::3]]))
    monkeypatch.setattr(ngram_join, "frequent_shingles", lambda texts: some)
    found = ngram_join.near_duplicates(frame(spark, near_rows)).collect()
    assert {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in found} == brute_components(near_rows)


def test_near_duplicates_odd_rows(spark):
    rows = [(None, "a b c d e f"), (None, None), (1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f g")]
    found = sorted(map(str, (tuple(row) for row in ngram_join.near_duplicates(frame(spark, rows)).collect())))
    assert found == sorted(map(str, [(None, 2, None), (None, 0, None), (1, 2, 1), (1, 2, 1), (2, 3, 2)]))
    assert ngram_join.near_duplicates(frame(spark, []).limit(0)).count() == 0


def test_bitmaps_differ_by_no_more_than_sets():
    draw = np.random.default_rng(1)
    for size in (1, 5, 60, 3000):
        for _ in range(20):
            common = draw.integers(0, 2**63, size).astype(np.uint64)
            x, y = (draw.integers(0, 2**63, draw.integers(0, size + 1)).astype(np.uint64) for _ in range(2))
            x, y = np.unique(np.concatenate([common, x])), np.unique(np.concatenate([common, y]))
            unlike = int(np.bitwise_count(ngram_join.bitmap(x) ^ ngram_join.bitmap(y)).sum())
            assert unlike <= len(np.setxor1d(x, y))


def test_a_shared_passage_makes_no_pairs(spark, monkeypatch):
    """Short documents around one passage: the pairs that come out are those that link."""
    draw = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(24))
    rows = [(i, passage + " " + " ".join(f"w{draw.randrange(10**6)}" for _ in range(draw.randint(14, 24)))) for i in range(800)]
    rows += [(1000 + i, text + " tail") for i, text in rows[:40]]
    made = []
    cross = ngram_join.cross_pairs

    def counted(mixed, percent):
        pairs = cross(mixed, percent)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(ngram_join, "cross_pairs", counted)
    monkeypatch.setattr(ngram_join, "ROUNDS", 1)
    found = {row["doc_id"]: row["component_id"] for row in ngram_join.near_duplicates(frame(spark, rows)).collect()}
    assert found == {i: i % 1000 for i, _ in rows}
    # There are 350,000 pairs around the passage.
    assert made[0] < 800


def test_bitmaps_grow_with_their_sets():
    draw = np.random.default_rng(2)
    for size in (600, 3000, 12_000):
        x, y = (np.unique(draw.integers(0, 2**63, size).astype(np.uint64)) for _ in range(2))
        words = ngram_join.bitmap_words(size)
        one, other = ngram_join.bitmap(x, words), ngram_join.bitmap(y, words)
        # Sets alike by 0.75 differ in a seventh of their shingles.
        assert np.bitwise_count(one ^ other).sum() * 175 > 2 * size * 25
        assert (one[: words // 2] ^ one[words // 2 :] == ngram_join.bitmap(x, words // 2)).all()


def crossed(rows, bitmaps):
    """The pairs of rows (place, doc_id, n, label, at)."""
    table = pa.table([pa.array(c, pa.int64()) for c in zip(*rows)], ["place", "doc_id", "n", "label", "at"])
    held = [(doc, n, bitmaps.get(doc, b"")) for doc, n in sorted({(row[1], row[2]) for row in rows}, reverse=True)]
    found = ngram_join._cross(table, pa.table([pa.array(c) for c in zip(*held)], ["doc_id", "n", "bitmap"]), 75)
    return sorted(zip(found.column("a").to_pylist(), found.column("b").to_pylist()))


def test_long_documents_around_a_passage_make_no_pairs():
    draw = np.random.default_rng(4)
    sets = {i: draw.integers(0, 2**63, 3000 + i).astype(np.uint64) for i in range(60)}
    sets[100] = np.concatenate([sets[7][:2800], draw.integers(0, 2**63, 100).astype(np.uint64)])
    bitmaps = {i: ngram_join.bitmap(x, ngram_join.bitmap_words(len(x))).tobytes() for i, x in sets.items()}
    rows = [(5, i, len(x), i, 3) for i, x in sets.items()] + [(6, i, len(x), i, 4) for i, x in sets.items()]
    assert crossed(rows, bitmaps) == [(7, 100)]
    # Where the place comes in them bounds what follows: 858 of 1,000 must be shared.
    assert crossed([(1, 1, 1000, 1, 142), (1, 2, 1000, 2, 142), (1, 3, 1000, 3, 143), (1, 4, 1000, 1, 0)], {}) == [(1, 2), (2, 4)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100)]
    found = {row["id"]: row["label"] for row in ngram_join.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


# Repeated strings


def brute_repeats(rows, length):
    seen = Counter()
    for i, text in rows:
        data = (text or "").encode()
        seen.update(data[p : p + length] for p in range(len(data) - length + 1))
    out = {}
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if seen[data[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for p in range(len(data)) if gone[p] and (p == 0 or not gone[p - 1]))
        out[i] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.fixture(scope="module")
def repeated_rows():
    draw = random.Random(5)

    def words(n):
        return " ".join(draw.choice(["alpha", "beta", "zeta", "été", "über"]) + str(draw.randint(0, 99)) for _ in range(n))

    passages = [words(30), words(12), words(60)]
    rows = []
    for i in range(90):
        text = words(draw.randint(0, 80))
        if draw.random() < 0.4:
            text += " " + draw.choice(passages) + " " + words(10)
        if draw.random() < 0.4 and rows:
            letters = list(rows[draw.randrange(len(rows))][1] or "x")
            letters[draw.randrange(len(letters))] = "Q"
            text = "".join(letters)
        rows.append((i, text))
    rows += [(500, None), (501, ""), (502, "a" * 900), (503, "ab" * 300), (None, passages[2])]
    return [*rows, (505, words(200) + passages[0] + passages[0])]


@pytest.mark.parametrize("length", [40, 100, 400])
def test_repeated_strings(spark, repeated_rows, length):
    found = suffix_dedup.without_repeats(frame(spark, repeated_rows), length).collect()
    got = {row["doc_id"]: (row["n_bytes"], row["n_removed"], row["n_spans"], row["kept_sha256"]) for row in found}
    assert got == brute_repeats(repeated_rows, length)


def test_repeats_of_nothing_and_of_rows(spark):
    assert suffix_dedup.without_repeats(frame(spark, []).limit(0)).count() == 0
    twice = frame(spark, [(1, "x1y2" * 200), (1, "x1y2" * 200)])
    assert [row["n_removed"] for row in suffix_dedup.without_repeats(twice).collect()] == [800, 800]


def test_repeats_go_by_rows_not_ids(spark):
    """Texts that share an id are cut each by what is repeated in it, and null ids take part."""
    draw = random.Random(9)
    a, b, tail = ("".join(draw.choices("abcdefghij ", k=900)) for _ in range(3))

    def removed(rows):
        found = suffix_dedup.without_repeats(frame(spark, rows))
        return Counter((row["doc_id"], row["n_bytes"], row["n_removed"]) for row in found.collect())

    assert removed([(1, a), (1, b + "!"), (2, a + tail)]) == Counter([(1, 900, 900), (1, 901, 0), (2, 1800, 900)])
    assert removed([(None, a), (2, a)]) == Counter([(None, 900, 900), (2, 900, 900)])
    assert removed([(None, a), (None, b), (3, tail)]) == Counter([(None, 900, 0), (None, 900, 0), (3, 900, 0)])


def test_boundaries_are_compared(spark):
    """Equal suffixes in different buckets still meet."""
    rows = [(7, 1, 1, i, 0, 0, 0) for i in range(40)] + [(9, 2, 2, 50, 0, 0, 0)]
    suffixes = spark.createDataFrame(rows, suffix_dedup.SUFFIX)
    found = suffix_dedup.repeated(suffixes, per_bucket=1)
    assert sorted(row["doc_id"] for row in found.collect()) == list(range(40))
