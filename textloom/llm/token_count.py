"""Token counts of a byte-level BPE vocabulary, with a shortcut for whole tokens.

Offline, every string of the vocabulary is run through the merges: where one token is left,
a pre-token equal to that string counts as one without any merging. Only the
pre-tokens outside this proven set are merged.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.pretokens import Memo, few_collections, splitter

MEMO = 1 << 19
SHORT = 48  # symbols up to which a piece is merged without a queue
UNRANKED = 1 << 60

SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


LETTERS = byte_letters()
_BYTE_OF = {letter: byte for byte, letter in enumerate(LETTERS)}
_TO_LETTERS = {byte: letter for byte, letter in enumerate(LETTERS)}


def merge(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge neighbours, the lowest rank first and of equal ranks the leftmost.

    Short pieces look for the best pair anew after each merge. For longer ones a queue of
    pairs over a linked list takes n log n steps, so one endless word is no trouble.
    """
    if len(symbols) <= SHORT:
        while len(symbols) > 1:
            found = [ranks.get(pair, UNRANKED) for pair in zip(symbols, symbols[1:])]
            best = min(found)
            if best == UNRANKED:
                break
            at = found.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols
    symbols = list(symbols)
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [
        (ranks[pair], i, pair) for i, pair in enumerate(zip(symbols, symbols[1:])) if pair in ranks
    ]
    heapq.heapify(queue)
    while queue:
        _, i, pair = heapq.heappop(queue)
        j = after[i]
        if symbols[i] != pair[0] or j >= n or symbols[j] != pair[1]:
            continue  # one of the two has been merged meanwhile
        symbols[i], symbols[j] = pair[0] + pair[1], ""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (found := (symbols[i], symbols[k])) in ranks:
                heapq.heappush(queue, (ranks[found], i, found))
        if (h := before[i]) >= 0 and (found := (symbols[h], symbols[i])) in ranks:
            heapq.heappush(queue, (ranks[found], h, found))
    return [symbol for symbol in symbols if symbol]


class TokenCounter:
    """Counts the tokens of texts as the vocabulary file ``content`` gives them."""

    def __init__(self, content: bytes, pattern: str):
        spec = json.loads(content)
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(merges)}
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.split = splitter(pattern)
        self.alone = self._prove(spec["model"]["vocab"])
        self.counts = Memo(self._merged, MEMO + len(self.alone), dict.fromkeys(self.alone, 1))

    def _prove(self, vocabulary: dict[str, int]) -> set[str]:
        """The vocabulary strings that the merges bring back to one token."""
        alone = set()
        for letters in vocabulary:
            if not all(letter in _BYTE_OF for letter in letters) or len(merge(list(letters), self.ranks)) > 1:
                continue
            try:
                alone.add(bytes(_BYTE_OF[letter] for letter in letters).decode())
            except UnicodeDecodeError:
                pass  # a part of a character is never a whole pre-token
        return alone

    def _merged(self, piece: str) -> int:
        return len(merge([_TO_LETTERS[b] for b in piece.encode()], self.ranks))

    def count(self, text: str) -> int:
        """Tokens of one text. A special string inside it is one token of its own."""
        parts = [text]
        for special in self.special:
            if special in text:
                parts = [part for whole in parts for part in whole.split(special)]
        return len(parts) - 1 + sum(sum(map(self.counts.__getitem__, self.split(part))) for part in parts)


@lru_cache(maxsize=4)
def counter(content: bytes, pattern: str) -> TokenCounter:
    """One counter per Python worker, kept for its later tasks."""
    made = TokenCounter(content, pattern)
    few_collections()
    return made


def _count(batches: Iterator[pa.RecordBatch], content: bytes, pattern: str) -> Iterator[pa.RecordBatch]:
    counts = counter(content, pattern)
    for batch in batches:
        texts = [text or "" for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(text.encode()) for text in texts], pa.int64()),
                pa.array([counts.count(text) for text in texts], pa.int64()),
            ],
            ["doc_id", "n_bytes", "n_tokens"],
        )


def token_counts(docs: DataFrame, vocabulary: bytes, pattern: str, limit: int) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per row of ``docs(doc_id, text, ...)``.

    ``vocabulary`` is the content of a tokenizer file (a megabyte or two, sent along with the
    tasks), ``pattern`` what splits text before the merges. A null or empty text has 0 bytes
    and 0 tokens; a null id is passed on; repeated rows are counted each; other columns
    are not looked at. Nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(partial(_count, content=vocabulary, pattern=pattern), SCHEMA)
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
