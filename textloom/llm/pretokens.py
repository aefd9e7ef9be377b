"""Cutting text into the pre-tokens that byte-level vocabularies merge within."""

from __future__ import annotations

import ctypes
import gc
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
import regex

# The standard engine is faster. Below U+0250 its classes differ from the Unicode ones on four
# control characters, which it takes for white space, and on numbers that are no decimal digits,
# which it takes for letters; texts that hold one of these, or anything above, go the slow way.
# The others' classes are written out as ranges, which it looks up in one step.
_BELOW = [chr(c) for c in range(0x250)]
_UNLIKE = "".join(c for c in _BELOW if unicodedata.category(c) in ("Nl", "No"))
_unlike = re.compile(f"[\x1c-\x1f{_UNLIKE}\u0250-\U0010ffff]")


def _ranges(belongs: Callable[[str], bool]) -> str:
    """The characters below U+0250 that belong, as a class of ranges."""
    runs = []
    for point in (ord(c) for c in _BELOW if belongs(c)):
        if runs and runs[-1][1] == point - 1:
            runs[-1][1] = point
        else:
            runs.append([point, point])
    return "[" + "".join(f"\\u{low:04x}-\\u{high:04x}" for low, high in runs) + "]"


_FAST = (
    (r"\p{L}", _ranges(str.isalpha)),
    (r"\p{N}", _ranges(str.isdecimal)),
    (r"[^\s\p{L}\p{N}]", _ranges(lambda c: not (c.isspace() or c.isalpha() or c.isdecimal() or c in _UNLIKE))),
)


def in_ranges(pattern: str) -> str:
    """The pattern for the standard engine, with classes written out for characters below U+0250."""
    fast = pattern.replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}")
    for unicode_class, ranges in reversed(_FAST):
        fast = fast.replace(unicode_class, ranges)
    return fast


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """A function that gives all matches of a pattern over ``\\p{L}``, ``\\p{N}`` and ``\\s``."""
    whole, quick = regex.compile(pattern), re.compile(in_ranges(pattern))

    def split(text: str) -> list[str]:
        return (whole if _unlike.search(text) else quick).findall(text)

    return split


def few_collections() -> None:
    """Large tables without cycles are not worth the cycle collector's time in a worker."""
    gc.freeze()
    gc.set_threshold(1 << 20)


def gives_back(work: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """The task ``work``; when it has ended, memory it no longer holds goes back to the system. A worker
    lives on for the tasks of later stages, next to workers that need the memory."""

    @wraps(work)
    def run(*given, **named):
        yield from work(*given, **named)
        give_back()

    return run


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


PIECE = 1_000  # rows


def in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time: what a task makes of them besides stays small."""
    for batch in batches:
        for low in range(0, max(1, batch.num_rows), PIECE):
            yield batch.slice(low, PIECE)


_held: dict = {}


def one_held(make: Callable) -> Callable:
    """``make`` with its last value kept for a worker's later tasks. A worker keeps one such value among all
    operators: what one has built is let go when another needs its own, as both need not fit."""

    @wraps(make)
    def get(*given):
        if _held.get("made") != (make, given):
            let_go()
            value = make(*given)
            _held.update(made=(make, given), value=value)
        return _held["value"]

    return get


def let_go() -> None:
    """Before work that needs the room: what an operator built is built again when it is asked for."""
    if _held:
        _held.clear()
        give_back()


class Memo(dict):
    """Values worked out once per key. When ``bound`` entries are held it starts anew, so
    a vocabulary that grows with the corpus never fills a worker's memory."""

    def __init__(self, work: Callable, bound: int, seed: dict | None = None):
        super().__init__(seed or {})
        self.work, self.bound, self.seed = work, bound, seed or {}

    def __missing__(self, key):
        if len(self) >= self.bound:
            self.clear()
            self.update(self.seed)
        value = self.work(key)
        if len(key) <= 64:
            self[key] = value
        return value
