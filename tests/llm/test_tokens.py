"""Tokenizing operators against the libraries they have to agree with."""

import hashlib
import random
import weakref
import zlib
from functools import partial

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from textloom.llm import bpe, packing, pretokens, token_count

PARTS = [
    "a", "  ", " ", "\n", "\t", "é", "É", "é", "ß", "中文", "\x1c", "½", "Ⅷ", "'s", "'LL", "12", "_", "!", "🙂", "İ", "Σ",
    "ΑΣ ", "ﬁ", "<|endoftext|>", "<|startoftext|>", "the", "ING", "tion", "\x00", "​",
]


def content(name):
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(11)
    made = ["".join(draw.choices(PARTS, k=draw.randint(0, 50))) for _ in range(400)]
    return [*made, None, "", " " * 2000, "a" * 4000, "ab" * 3000, made[0]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    """With ids that are null or repeat, and columns named like the operators' own."""
    rows = [(None if i == 5 else 7 if i == 8 else i, text, "x", 1) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string, n bigint")


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(content("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_transducer_equals_the_library(texts, library):
    own = bpe.Codec(content("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    for text in texts:
        assert own.encode(text or "") == library.encode_ordinary(text or "")


def test_few_states_change_nothing(texts, library):
    ranks = bpe.read_ranks(content("byte_bpe_multi_50k.tiktoken"))
    machine = bpe.Transducer(ranks, states=10)
    for piece in ("tokenization", "über", "aaaaaaaaaaaaaaa"):
        assert machine.encode(piece.encode()) == library.encode_ordinary(piece)


def test_round_trip(spark, docs, texts, library):
    ranks = content("byte_bpe_multi_50k.tiktoken")
    found = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).collect()
    want = []
    for text in texts:
        ids = library.encode_ordinary(text or "")
        want.append(
            (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        )
    assert sorted(tuple(row)[1:] for row in found) == sorted(want)
    back = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks, public_tokenizers.PATTERN)
    assert sorted(row["text"] for row in back.collect()) == sorted(text or "" for text in texts)


def test_stream_holds_back_unfinished_characters():
    data = "aé中🙂z".encode()
    for size in (1, 2, 3, 5):
        stream = bpe.Utf8Stream()
        parts = [stream.feed(data[i : i + size]) for i in range(0, len(data), size)]
        assert "".join(parts) + stream.end() == "aé中🙂z"
        assert "�" not in "".join(parts)
    cut = bpe.Utf8Stream()
    assert cut.feed(b"a\xe4\xb8") + cut.end() == "a�"
    assert bpe.Utf8Stream().feed(b"\xffb") == "�b"


def test_token_counts_equal_the_library(docs, texts):
    name = "byte_bpe_50k.json"
    library = Tokenizer.from_file(public_tokenizers.path(name))
    found = token_count.token_counts(docs, content(name), public_tokenizers.PATTERN, 30).collect()
    want = [len(library.encode(text or "", add_special_tokens=False).ids) for text in texts]
    assert sorted((row["n_bytes"], row["n_tokens"], row["over_limit"]) for row in found) == sorted(
        (len((text or "").encode()), n, n > 30) for text, n in zip(texts, want)
    )


def test_long_and_short_merges_agree():
    counter = token_count.TokenCounter(content("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    draw = random.Random(4)
    for _ in range(200):
        symbols = [draw.choice("theinongat") for _ in range(draw.randint(2, 45))]
        short = token_count.merge(list(symbols), counter.ranks)
        # A piece above the bound goes the other way; a part no merge crosses keeps it the same.
        long = token_count.merge([*symbols, *["Ā"] * token_count.SHORT], counter.ranks)
        assert long[: len(short)] == short


def test_whole_tokens_are_proven():
    counter = token_count.TokenCounter(content("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    assert len(counter.alone) > 40_000
    for piece in list(counter.alone)[:2000]:
        assert counter._merged(piece) == 1


def pack(docs, window=packing.WINDOW):
    return packing.packed(docs, partial(packing.word_encoder, content("word_bpe_49k.json")), window)


@pytest.mark.parametrize("window", [2048, 64, 7])
def test_packing(docs, texts, window):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    numbered = docs.sparkSession.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = pack(numbered, window).collect()
    want = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    held = {}
    for row in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        ids = np.array(want[row["doc_id"]], "<u4")[row["start"] : row["start"] + row["length"]]
        assert zlib.crc32(ids.tobytes()) == row["ids_crc32"]
        assert bytes(row["ids"]) == ids.tobytes()
        assert row["doc_tokens"] == len(want[row["doc_id"]])
        assert held.get(row["doc_id"], 0) == row["start"]
        held[row["doc_id"]] = row["start"] + row["length"]
    assert held == {i: len(ids) for i, ids in want.items()}
    places = sorted((row["sequence_id"], row["offset"], row["length"]) for row in rows)
    at = 0
    for sequence, offset, length in places:
        assert sequence * window + offset == at
        assert offset + length <= window
        at += length
    whole = {row["sequence_id"]: len(row["ids"]) // 4 for row in packing.sequences(pack(numbered, window)).collect()}
    assert sum(whole.values()) == at
    assert all(size == window for sequence, size in whole.items() if sequence != max(whole))


def test_packing_takes_small_batches_and_cuts_in_generated_code(docs, monkeypatch):
    spark, name = docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    seen, written, before = {}, packing.materialize, spark.conf.get(name)

    def spied(df, label):
        seen[label] = int(spark.conf.get(name))
        return written(df, label)

    monkeypatch.setattr(packing, "materialize", spied)
    plan = pack(docs)._jdf.queryExecution().executedPlan().toString()
    assert seen == {"placed": pretokens.PIECE} and spark.conf.get(name) == before
    assert "lambdafunction" not in plan and "explode" in plan


def test_packing_odd_rows(docs, texts):
    assert pack(docs).selectExpr("sum(length)", "count(distinct sequence_id)").first()[0] == sum(
        row["length"] for row in pack(docs).collect()
    )
    assert pack(docs.limit(0)).count() == 0


def test_empty_tables(docs):
    none = docs.limit(0)
    assert bpe.round_trip(none, content("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0
    assert token_count.token_counts(none, content("byte_bpe_50k.json"), public_tokenizers.PATTERN, 5).count() == 0


def test_ranges_split_as_the_classes_do():
    """Every character below U+0250 alone and among others; the standard engine meets ranges only."""
    draw = random.Random(12)
    letters = [chr(c) for c in range(0x252)]
    tried = [text for c in letters for text in (c, f"a{c}1", f" {c}!", c + c)]
    tried += ["".join(draw.choices([*letters, *"  ''sdtmlre\n1,"], k=draw.randint(0, 20))) for _ in range(2000)]
    words = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    for pattern in (public_tokenizers.PATTERN, words):
        assert not any(kind in pretokens.in_ranges(pattern) for kind in (r"\W", r"\d", r"\p"))
        split, whole = pretokens.splitter(pattern), regex.compile(pattern)
        for text in tried:
            assert split(text) == whole.findall(text)


def test_a_worker_keeps_what_one_operator_built():
    built = [0, 0]

    @pretokens.one_held
    def one(size):
        built[0] += 1
        return np.zeros(size)

    @pretokens.one_held
    def other():
        built[1] += 1
        return set()

    first = weakref.ref(one(3))
    assert one(3) is first() and built == [1, 0]
    assert other() is other() and built == [1, 1]
    assert first() is None
    assert len(one(4)) == 4 and len(one(5)) == 5 and built == [3, 1]
    pretokens.let_go()
    assert len(one(5)) == 5 and built == [4, 1]


def test_what_is_let_go_goes_back_to_the_system(monkeypatch):
    given = []
    monkeypatch.setattr(pretokens, "give_back", lambda: given.append(1))
    made = pretokens.one_held(lambda size: np.zeros(size))
    pretokens.let_go()
    before = len(given)
    made(3)
    made(3)
    assert len(given) == before  # nothing was held
    made(4)
    pretokens.let_go()
    pretokens.let_go()
    assert len(given) == before + 2
