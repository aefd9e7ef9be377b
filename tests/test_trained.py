"""What the library learns from a corpus or keeps between batches, against brute force."""

import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from textloom import session
from textloom.functions import text as tx
from textloom.functions.text import DOTTED, LAST_PIECE
from textloom.operators import blockmax, boundaries, index, search, weights
from textloom.sources import documents as docs
from textloom.streaming import ingest


def prose(dice, n):
    """Sentences of common words, with abbreviations in their middle and at their end."""
    words = ["river", "stone", "walks", "under", "bright", "morning", "seven", "garden", "almost", "quiet"]
    short = ["Dr.", "approx.", "e.g.", "Nr."]
    out = []
    for _ in range(n):
        sentence = dice.choices(words, k=dice.randint(4, 9))
        if dice.random() < 0.5:
            sentence.insert(dice.randint(1, len(sentence) - 1), dice.choice(short))
        out.append(" ".join(sentence) + dice.choice([".", ".", ".", "!", "?"]))
    return out


def test_planted_abbreviations_end_no_sentence(spark):
    dice = random.Random(1)
    made = [prose(dice, 40) for _ in range(60)]
    corpus = spark.createDataFrame([(i, " ".join(s)) for i, s in enumerate(made)], "doc_id bigint, text string")
    known = boundaries.abbreviations(corpus)
    assert {row["word"] for row in known.collect()} == {"dr", "approx", "e.g", "nr"}
    found = boundaries.trained_sentences(corpus, known).orderBy("doc_id", "i").collect()
    assert [(r["doc_id"], r["i"], r["sentence"]) for r in found] == [(i, k, s) for i, ss in enumerate(made) for k, s in enumerate(ss)]


def test_score_by_hand(spark):
    corpus = spark.createDataFrame([(1, "ca. ca. ca. ca. big end. Ca big 12. (ca.) x")], "doc_id bigint, text string")
    counts = {r["word"]: (r["dotted"], r["plain"]) for r in boundaries.period_counts(corpus).collect()}
    assert counts == {"ca": (5, 1), "big": (0, 2), "end": (1, 0), "12": (1, 0), "x": (0, 1)}
    share = 7 / 11
    ratio = 2 * (5 * math.log(0.99 / share) + math.log(0.01 / (1 - share)))
    score = ratio * math.exp(-2) * 1 * 2**-1
    found = {r["word"]: r["score"] for r in boundaries.abbreviations(corpus, threshold=-10).collect()}
    assert set(found) == {"ca", "end"}
    assert found["ca"] == pytest.approx(score, abs=1e-6)


def test_sentences_without_known_words_are_the_plain_ones(spark):
    texts = ["One. Two!  Three?\nFour.", "", "  \n", "no end", "a.\n\nb. \n", "Wait... (Yes.) \"No.\" Go", None]
    corpus = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    none = spark.createDataFrame([], "word string")
    plain = corpus.select("doc_id", F.posexplode(tx.split_sentences("text")).alias("i", "sentence"))
    assert sorted(boundaries.trained_sentences(corpus, none).collect()) == sorted(plain.collect())
    known = spark.createDataFrame([("a",), ("one",)], "word string")
    joined = {(r["doc_id"], r["i"]): r["sentence"] for r in boundaries.trained_sentences(corpus, known).collect()}
    assert joined[0, 0] == "One. Two!" and joined[4, 0] == "a.b."
    assert boundaries.abbreviations(corpus.limit(0)).count() == 0


def test_arrivals_in_batches_are_weighed_as_in_one(spark, tmp_path, rows_of):
    dice = random.Random(2)
    texts = [" ".join(f"w{min(dice.randrange(6), dice.randrange(6))}" for _ in range(dice.randrange(7))) for _ in range(24)]
    whole = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    inbox, path, log = (str(tmp_path / name) for name in ("inbox", "weighed", "log"))
    shaped = whole.withColumns({"lang": F.lit("x"), "source": F.lit("y"), "n_chars": F.lit(0).cast("long")})

    def arrive(low, high):
        shaped.where(F.col("doc_id").between(low, high)).coalesce(1).write.mode("append").parquet(inbox)
        ingest.ingest_weights(ingest.document_stream(spark, inbox, files_per_batch=1), path, log, tx.tokenize_words("text"))

    def weighed():
        return sorted((d, t, round(w, 9)) for d, t, w in ingest.ingested_weights(spark, path).collect())

    arrive(0, 9)
    arrive(10, 17)
    assert ingest.compact(spark, path) == 0
    arrive(18, 23)
    expected = weights.tfidf_arrival(whole, tx.tokenize_words("text"))
    assert weighed() == sorted((d, t, round(w, 9)) for d, t, w in expected.collect())
    assert rows_of(ingest.ingested_documents(spark, path)) == [(24,)]
    # The last batch is repeated, as after a failure between its writes and the stream's log.
    (tmp_path / "log" / "commits" / "2").unlink()
    (tmp_path / "log" / "commits" / ".2.crc").unlink(missing_ok=True)
    ingest.ingest_weights(ingest.document_stream(spark, inbox, files_per_batch=1), path, log, tx.tokenize_words("text"))
    assert weighed() == sorted((d, t, round(w, 9)) for d, t, w in expected.collect())
    assert rows_of(ingest.ingested_documents(spark, path)) == [(24,)]


def test_last_words_are_found_from_the_end(spark):
    dice = random.Random(9)
    parts = ["a", "Dr.", ".", ")", " ", "\n", "\u0085", "\u2003", "\u2028", "x.y", "\U0001f642", "é.\"", "?"]
    rows = [("".join(dice.choices(parts, k=dice.randrange(9))),) for _ in range(3000)]
    found = spark.createDataFrame(rows, "piece string").select(
        F.regexp_extract("piece", LAST_PIECE, 1).alias("last"), F.regexp_extract("piece", boundaries.FROM_END, 1).alias("own"),
    ).withColumns({"dot": F.col("last").rlike(DOTTED), "seen": boundaries.ends_dotted(F.col("last"))})
    assert found.where("last != own OR dot != seen").count() == 0
    assert found.where("dot").count() > 100


def themed(dice, n):
    """Documents of many themes, so that a query's best documents stand out."""
    common = [f"c{i}" for i in range(5)]
    return [" ".join(dice.choices([f"t{i % 40}x{j}" for j in range(6)], k=8) + dice.choices(common, k=2)) for i in range(n)]


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_blocks_find_what_the_full_search_finds(spark, corpus_of, rows_of, tmp_path, limit):
    dice = random.Random(3)
    texts = themed(dice, 300)
    texts += [texts[0]] * 15 + ["", "c0"]  # ties around the k-th place
    built = index.build_index(corpus_of(*texts))
    queries = [texts[0], texts[5] + " " + texts[6], "c0 c1", "t3x1", "", "unknown words"]
    queries = spark.createDataFrame(list(enumerate(queries)), "qid bigint, text string")
    made = blockmax.in_blocks(built, docs_per_block=8, limit=limit)
    made.save(str(tmp_path / "blocks"))
    made = blockmax.BlockIndex.load(spark, str(tmp_path / "blocks"))
    expected = rows_of(search.search_top_k(built, queries, 7), "qid", "rank")
    assert rows_of(blockmax.search_blocks(made, queries, 7, limit), "qid", "rank") == expected


def test_most_postings_are_skipped(spark, corpus_of):
    dice = random.Random(4)
    texts = themed(dice, 2000)
    built = index.build_index(corpus_of(*texts))
    queries = spark.createDataFrame([(i, texts[i]) for i in range(40)], "qid bigint, text string")
    report = {}
    blockmax.search_blocks(blockmax.in_blocks(built, docs_per_block=16), queries, 5, report=report).count()
    terms = search.query_vectors(built, queries).agg(F.sum("df")).first()[0]
    assert report["postings"] * 3 < terms


def test_lists_move_whole(spark, corpus_of):
    """Lists are dealt by query and block; postings and documents are never dealt by themselves."""
    texts = themed(random.Random(5), 200)
    queries = spark.createDataFrame([(i, texts[i]) for i in range(5)], "qid bigint, text string")
    found = blockmax.search_blocks(blockmax.in_blocks(index.build_index(corpus_of(*texts)), 8), queries, 5)
    plan = found._jdf.queryExecution().toString()
    assert "hashpartitioning(qid" in plan
    assert not [line for line in plan.splitlines() if "hashpartitioning" in line and "doc_id" in line]


def test_pairs_of_query_and_block_are_formed_in_place(spark, corpus_of, monkeypatch):
    """Only the first blocks of a query are found by shuffling by query and block; its other lists stay where they were
    dealt, and nothing that was found there is written but the best."""
    texts = themed(random.Random(6), 200)
    queries = spark.createDataFrame([(i, texts[i]) for i in range(5)], "qid bigint, text string")
    plans = {}

    def noted(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return session.materialize(df, label)

    monkeypatch.setattr(blockmax, "materialize", noted)
    blockmax.search_blocks(blockmax.in_blocks(index.build_index(corpus_of(*texts)), 8), queries, 5)
    by_pair = {label for label, plan in plans.items() if re.search(r"hashpartitioning\(qid#\d+L?, block", plan)}
    assert by_pair <= {"seed-blocks", "seed-scores"}
    assert not any("in-reach" in label or "asked" in label for label in plans)
    postings = [line for line in plans["posting-blocks"].splitlines() if "Exchange hashpartitioning" in line]
    assert postings and all("(_deal" in line for line in postings)


def test_shuffled_blocks_go_with_their_write(spark, corpus_of):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {name for name in names if name.startswith("shuffle_")}

    texts = themed(random.Random(7), 100)
    built = index.build_index(corpus_of(*texts))
    queries = spark.createDataFrame([(i, texts[i]) for i in range(5)], "qid bigint, text string")
    before = shuffled()
    blockmax.search_blocks(blockmax.in_blocks(built, 8), queries, 5)
    for _ in range(40):  # they go in the background
        if not shuffled() - before:
            break
        time.sleep(0.5)
    assert not shuffled() - before
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_lists_hold_any_term(spark):
    rows = [(d, t, d + n + 1) for d in range(6) for n, t in enumerate(["", "a", "a\0b", "b\0", "é", "x" * 300][: d + 1])]
    postings = spark.createDataFrame(rows, "doc_id bigint, term string, tf bigint").coalesce(2)
    plain = postings.where("term NOT LIKE '%\0%'")
    for found in (postings, plain):
        held = {(d, t): tf for d, t, tf in found.collect()}
        built = index.Index(found, index.posting_frequency(found), 6)
        norms = dict(weights.document_norms(built).collect())
        lists = blockmax.in_blocks(built, 2).lists.collect()
        assert all(1 <= len(row["doc_ids"]) <= 2 and row["top"] == max(row["parts"]) for row in lists)
        unfolded = {(d, row["term"]): part for row in lists for d, part in zip(row["doc_ids"], row["parts"])}
        assert unfolded == {(d, t): pytest.approx(tf / norms[d], rel=1e-12) for (d, t), tf in held.items()}
        assert sum(len(row["doc_ids"]) for row in lists) == len(held)


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_repeated_and_null_ids_are_found_by_blocks(spark, rows_of, limit):
    dice = random.Random(8)
    texts = themed(dice, 120)
    corpus = list(enumerate(texts)) + [(i % 7, text) for i, text in enumerate(texts[60:90])] + [(None, texts[0])]
    built = index.build_index(spark.createDataFrame(corpus, "doc_id bigint, text string"))
    asked = [(i % 5, text) for i, text in enumerate(texts[:9])] + [(7, None), (8, "c0 c1 c2")]
    queries = spark.createDataFrame(asked, "qid bigint, text string")
    expected = rows_of(search.search_top_k(built, queries, 4), "qid", "rank")
    assert rows_of(blockmax.search_blocks(blockmax.in_blocks(built, 8, limit), queries, 4, limit), "qid", "rank") == expected
