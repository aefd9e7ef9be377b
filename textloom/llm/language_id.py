"""Language identification by cross-parsing.

Of each language a piece of labelled text is turned into a suffix automaton. A text is then
parsed against every automaton: from where it stands, the longest match that the language's
text holds is one phrase, and the next phrase starts behind it. Text in the language needs few,
long phrases; the language with the fewest per character wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.pretokens import gives_back, one_held

TRAINING_CHARS = 40_000  # of labelled text per language
TRAINING_PIECE = 1_000  # at most so much of it from one document
MAX_LANGUAGES = 200
DENSE = 63  # letters of a language with a column in its table; the others' steps are looked up
WINDOW = 1_024  # characters parsed in one go; each window begins a new phrase
ROWS = 16_384  # windows parsed side by side
UNKNOWN = "und"

_MISS = np.int32(1 << 30)
_STATE = np.int32((1 << 30) - 1)

SCHEMA = "doc_id long, lang_pred string, score double, rejected boolean"


def folded(text: str) -> np.ndarray:
    """Lower-case letters as code points; every run of anything else is one 0."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    table = _letter_table()
    points = np.where(table[np.minimum(points, len(table) - 1)], points, 0)
    return points[(points != 0) | np.concatenate(([False], points[:-1] != 0))]


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def transitions(word: list[int]) -> list[dict[int, int]]:
    """The suffix automaton of ``word``: of each state, the next one by kind of letter."""
    ahead: list[dict[int, int]] = [{}]
    length, link = [0], [-1]
    last = 0
    for kind in word:
        new = len(ahead)
        ahead.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and kind not in ahead[at]:
            ahead[at][kind] = new
            at = link[at]
        if at != -1:
            target = ahead[at][kind]
            if length[at] + 1 == length[target]:
                link[new] = target
            else:
                # A shorter string ends in the same state: give it one of its own.
                own = len(ahead)
                ahead.append(ahead[target].copy())
                length.append(length[at] + 1)
                link.append(link[target])
                while at != -1 and ahead[at].get(kind) == target:
                    ahead[at][kind] = own
                    at = link[at]
                link[target] = link[new] = own
        last = new
    return ahead


def _edges(ahead: list[dict[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """State, kind and next state of every transition."""
    state = np.repeat(np.arange(len(ahead), dtype=np.int64), [len(ways) for ways in ahead])
    kind = np.fromiter((kind for ways in ahead for kind in ways), np.int64, len(state))
    following = np.fromiter((at for ways in ahead for at in ways.values()), np.int32, len(state))
    return state, kind, following


def _table(states: int, kinds: int, state: np.ndarray, kind: np.ndarray, following: np.ndarray) -> np.ndarray:
    table = np.full((states, kinds), -1, np.int32)
    table[state, kind] = following
    root = np.where(table[0] == -1, 0, table[0]) | _MISS
    for column, miss in zip(table.T, root):
        column[column == -1] = miss
    return table


def automaton(word: list[int], kinds: int) -> np.ndarray:
    """The suffix automaton of ``word`` as a table of states x kinds.

    An entry is the next state; where a state has no way on, it is that of the root, marked as a
    miss: the phrase ends there and the next begins with this character.
    """
    ahead = transitions(word)
    return _table(len(ahead), kinds, *_edges(ahead))


class Automaton:
    """The suffix automaton of one language's text, for letters of any number of kinds.

    Its most frequent letters have a column each in a table, letters that it does not hold share
    the last one, and the other letters' transitions are sorted by state and kind.
    """

    def __init__(self, word: np.ndarray, kinds: int):
        counts = np.bincount(word, minlength=kinds)
        own = np.flatnonzero(counts)
        dense = own[np.argsort(-counts[own], kind="stable")[:DENSE]]
        self.width = len(dense) + 1  # the last column: letters that the text does not hold
        self.rare = self.width
        self.column = np.full(kinds, self.width - 1, np.uint8)
        self.column[own] = self.rare
        self.column[dense] = np.arange(len(dense))
        self.kinds = kinds
        ahead = transitions(word.tolist())
        state, kind, following = _edges(ahead)
        column = self.column[kind]
        held = column < self.rare
        self.table = _table(len(ahead), self.width, state[held], column[held], following[held]).ravel()
        keys = state[~held] * kinds + kind[~held]
        order = np.argsort(keys)
        self.keys, self.following = keys[order], following[~held][order]

    def steps(self, state: np.ndarray, columns: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """From each state by each letter: the next state, marked where the phrase ended."""
        rare = np.flatnonzero(columns == self.rare) if len(self.keys) else ()
        if not len(rare):
            return self.table[state * self.width + columns]
        ahead = self.table[state * self.width + np.minimum(columns, self.width - 1)]
        kind = kinds[rare].astype(np.int64)
        key = state[rare] * np.int64(self.kinds) + kind
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        # Every letter of the text has a way from the root, which is state 0.
        root = self.following[np.searchsorted(self.keys, kind)]
        ahead[rare] = np.where(self.keys[at] == key, self.following[at], root | _MISS)
        return ahead


class CrossParser:
    """Automata of several languages over one alphabet: every letter of the training texts."""

    def __init__(self, training: dict[str, str]):
        self.languages = sorted(training)
        texts = [folded(training[language]) for language in self.languages]
        self.letters = np.unique(np.concatenate([*texts, np.zeros(1, np.uint32)]))
        kinds = len(self.letters) + 1  # the last kind: letters that no training text holds
        self.automata = [Automaton(self.kind(text), kinds) for text in texts]

    def kind(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at, len(self.letters)).astype(
            np.uint16 if len(self.letters) < 1 << 16 else np.uint32
        )

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (rows) in each language, windows added up."""
        owners, windows = [], []
        for owner, text in enumerate(texts):
            kinds = self.kind(text)
            for low in range(0, len(kinds), WINDOW):
                owners.append(owner)
                windows.append(kinds[low : low + WINDOW])
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        order = sorted(range(len(windows)), key=lambda i: -len(windows[i]))
        for low in range(0, len(order), ROWS):
            part = order[low : low + ROWS]
            found = self._parse([windows[i] for i in part])
            np.add.at(total, np.array([owners[i] for i in part]), found)
        return total

    def _parse(self, windows: list[np.ndarray]) -> np.ndarray:
        """Windows in order of falling length, one character of all of them at a time."""
        lengths = np.array([len(w) for w in windows])
        grid = np.zeros((int(lengths[0]), len(windows)), windows[0].dtype)
        for i, window in enumerate(windows):
            grid[: len(window), i] = window
        going = np.searchsorted(-lengths, -np.arange(len(grid)), side="left")
        found = np.ones((len(windows), len(self.languages)), np.int64)
        for number, own in enumerate(self.automata):
            state = np.zeros(len(windows), np.int32)
            missed = np.zeros(len(windows), np.int32)
            for step, kinds in enumerate(grid):
                n = int(going[step])
                ahead = own.steps(state[:n], own.column[kinds[:n]], kinds[:n])
                missed[:n] += ahead >= _MISS
                state[:n] = ahead & _STATE
            found[:, number] += missed
        return found

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """The language of each text, by how much its phrases are fewer than the runner-up's, and
        whether it has no language or none that fits: none of its letters is in a training text."""
        points = [folded(text or "") for text in texts]
        found = self.phrases(points)
        languages, scores, rejected = [], [], []
        for text, row in zip(points, found):
            if not text.any() or not self.languages:
                languages.append(UNKNOWN)
                scores.append(0.0)
                rejected.append(not text.any())
                continue
            # Letters that no language knows are phrases of one letter in all of them.
            rejected.append(bool(row.min() == row.max()) and not np.isin(text[text != 0], self.letters).any())
            order = np.argsort(row, kind="stable")
            languages.append(self.languages[order[0]])
            scores.append(1.0 - row[order[0]] / row[order[1]] if len(order) > 1 else 1.0)
        return languages, scores, rejected


def training_texts(labelled: DataFrame, chars: int = TRAINING_CHARS, piece: int = TRAINING_PIECE) -> dict[str, str]:
    """Up to ``chars`` characters of text for each language of ``labelled(doc_id, text, lang)``.

    A bounded sample of the labelled rows, documents in the order of a hash of their id, up
    to ``piece`` characters from each. What reaches the driver is at most
    ``MAX_LANGUAGES * chars`` characters; more languages raise an error. ``und`` is no language.
    """
    known = labelled.where("lang is not null and text is not null and lang != ''").where(F.col("lang") != UNKNOWN)
    need = -(-chars // piece)
    # A long document gives one piece, a short one all of itself; many short ones may be needed.
    pieces = known.select(
        "lang", F.substring("text", 1, piece).alias("piece"), F.xxhash64("doc_id").alias("place")
    ).where(F.length(F.trim("piece")) > 0)
    least = pieces.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.avg(F.length("piece")).alias("mean"))
    sizes = least.limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    texts = {}
    if not sizes:
        return texts
    # Take about four times the rows needed by hash range, so that few rows are ever sorted.
    share = F.lit(1.0)
    for row in sizes:
        wanted = 4.0 * max(need, chars / row["mean"]) + 20
        share = F.when(F.col("lang") == row["lang"], F.lit(min(1.0, wanted / row["n"]))).otherwise(share)
    drawn = pieces.where(F.pmod("place", F.lit(1 << 20)) < share * (1 << 20))
    in_order = drawn.groupBy("lang").agg(
        F.substring(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "piece"))), lambda p: p["piece"]), "\n"),
            1, chars,
        ).alias("text")
    )
    return {row["lang"]: row["text"] for row in in_order.collect()}


@one_held
def parser(training: tuple[tuple[str, str], ...]) -> CrossParser:
    """One set of automata per Python worker, kept for its later tasks."""
    return CrossParser(dict(training))


TEXTS_AT_ONCE = 1 << 21  # characters


@gives_back
def _predict(
    batches: Iterator[pa.RecordBatch], training: tuple[tuple[str, str], ...]
) -> Iterator[pa.RecordBatch]:
    own = parser(training)

    def answered(ids: list, texts: list) -> pa.RecordBatch:
        languages, scores, rejected = own.predict(texts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array(languages, pa.string()), pa.array(scores, pa.float64()),
                pa.array(rejected, pa.bool_()),
            ],
            ["doc_id", "lang_pred", "score", "rejected"],
        )

    for batch in batches:
        ids, texts, held = [], [], 0
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids.append(doc)
            texts.append(text)
            held += len(text or "")
            if held >= TEXTS_AT_ONCE:
                yield answered(ids, texts)
                ids, texts, held = [], [], 0
        if ids:
            yield answered(ids, texts)


def languages(docs: DataFrame, training: dict[str, str]) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` for each row of ``docs(doc_id, text, ...)``.

    The prediction looks at the text alone and at all of it. ``score`` is 0 where two languages
    need equally many phrases (the first in the alphabet is taken), and nears 1 where
    one needs far fewer. ``und`` with score 0: the text is null or has no letter, or there
    was nothing to learn from. ``rejected``: the text is null or has no letter, or something was
    learned and none of its letters is in any of the training texts. With one language learned, all other texts get it with score 1. A null
    id is passed on, repeated rows are answered each, no rows give none; other columns
    are not looked at. Nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_predict, training=tuple(sorted(training.items()))), SCHEMA)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from the training: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
