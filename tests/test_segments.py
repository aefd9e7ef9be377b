"""Appends, deletes and merges against an index that is built anew."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import index, joins, search, segments, weights


def tables(built, docs=None):
    found = {
        "postings": sorted(map(tuple, built.postings.select("doc_id", "term", "tf").collect())),
        "stats": sorted(map(tuple, built.stats.select("term", "df").collect())),
        "n_docs": built.n_docs,
    }
    if built.n_docs:
        norms = weights.document_norms(built).select("doc_id", F.round("norm", 9))
        found["norms"] = sorted(map(tuple, norms.collect()))
        lists = index.inverted_index(built.postings, ids_per_block=10)
        found["lists"] = sorted((r["term"], r["block"], tuple(r["doc_ids"])) for r in lists.collect())
        found["ranked"] = list(map(tuple, search.ranked_search(built, "w1 w2 w3").collect()))
    return found


def corpus(spark, texts):
    return spark.createDataFrame(sorted(texts.items()), "doc_id bigint, text string")


@pytest.mark.parametrize("broadcast", [True, False])
def test_changes_equal_a_rebuild(spark, tmp_path, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(segments, "fits_broadcast", lambda table: False)
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    dice = random.Random(1)
    path = str(tmp_path / "index")

    def texts(ids):
        return {i: " ".join(f"w{min(dice.randrange(9), dice.randrange(9))}" for _ in range(dice.randrange(6))) for i in ids}

    living, history = {}, {}
    steps = [
        ("append", texts(range(12))), ("append", texts(range(20, 28))), ("delete", [3, 21, 99]), ("append", texts([3, 5, 40])),
        ("merge", None), ("delete", [3, 40]), ("append", texts([40, -7])), ("append", {}),
    ]
    for at, (kind, given) in enumerate(steps):
        if kind == "append":
            state = segments.append(spark, path, corpus(spark, given), f"run-{at}")
            living |= given
        elif kind == "delete":
            state = segments.delete(spark, path, spark.createDataFrame([(i,) for i in given], "doc_id bigint"), f"run-{at}")
            living = {i: t for i, t in living.items() if i not in given}
        else:
            state = segments.merge(spark, path, f"run-{at}")
            assert len(state.parts) == 1
        history[state.version] = dict(living)
        if at in (3, 7):
            assert tables(segments.load(spark, path)) == tables(index.build_index(corpus(spark, living)))
            assert sorted(r[0] for r in segments.documents(spark, path).collect()) == sorted(living)
    # A reader may stay with any snapshot.
    built = segments.load(spark, path, 2)
    assert built.n_docs == len(history[2])
    assert {r[0] for r in built.postings.select("doc_id").distinct().collect()} == {i for i, t in history[2].items() if t}


def test_a_run_that_is_repeated_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "index")
    docs = corpus(spark, {1: "red fox", 2: "hen"})
    first = segments.append(spark, path, docs, "a")
    assert segments.append(spark, path, docs, "a") == first
    gone = segments.delete(spark, path, docs.where("doc_id = 1"), "b")
    assert segments.delete(spark, path, docs, "b") == gone
    merged = segments.merge(spark, path, "c")
    assert segments.merge(spark, path, "c") == merged
    assert segments.load(spark, path).n_docs == 1


def test_a_change_that_fails_is_not_seen(spark, tmp_path, monkeypatch):
    """What was written before the manifest is invisible, and the run can be made again."""
    path = str(tmp_path / "index")
    segments.append(spark, path, corpus(spark, {1: "red fox"}), "a")

    def broken(*given):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(segments, "_commit", broken)
        with pytest.raises(OSError, match="lost"):
            segments.append(spark, path, corpus(spark, {1: "blue", 2: "hen"}), "b")
    assert tables(segments.load(spark, path)) == tables(index.build_index(corpus(spark, {1: "red fox"})))
    segments.append(spark, path, corpus(spark, {1: "blue", 2: "hen"}), "b")
    assert tables(segments.load(spark, path)) == tables(index.build_index(corpus(spark, {1: "blue", 2: "hen"})))


def test_nothing_written(spark, tmp_path):
    path = str(tmp_path / "index")
    assert segments.snapshot(spark, path).version == -1
    assert segments.load(spark, path).n_docs == 0
    with pytest.raises(ValueError, match="no snapshot 4"):
        segments.load(spark, path, 4)
