"""Byte-level BPE as a finite-state transducer, and streaming decoding.

Two facts make the merges of BPE a left-to-right machine. A token sequence is the encoding of
its bytes exactly when each two neighbours are the encoding of theirs; and so every prefix
of a text has one encoding. After some bytes the machine holds its hypotheses: prefixes that
end in a known token, each followed by bytes that spell the beginning of a further token. On a
byte each hypothesis moves on in the trie of tokens or dies, and one new prefix is complete.
Tokens that all hypotheses share are emitted. A hypothesis lives no longer than the longest
token, which bounds the lookahead. Sets of hypotheses are numbered as states when they
are first met, and their transitions are kept, so only new states cost anything.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.pretokens import Memo, few_collections, splitter

STATES = 1 << 18  # states held at once; beyond it the table starts anew
PAIRS = 1 << 19  # answers held about which tokens follow one another
MEMO = 1 << 20  # pre-tokens whose output is held

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

MANY = 32  # tokens below a trie node that are not looked through

_FOREVER = float("inf")
_START = -1
_MEANING = -1  # where a state keeps what it means


def read_ranks(content: bytes) -> dict[bytes, int]:
    """The ranks in a file of lines ``base64(token) rank``."""
    pairs = (line.split() for line in content.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Transducer:
    """Merge ranks compiled into a transducer from bytes to token ids."""

    def __init__(self, ranks: dict[bytes, int], states: int = STATES):
        self.token_of = {rank: token for token, rank in ranks.items()}
        self.limit = states
        self._parts: dict[int, tuple[int, int]] = {}
        self._fused: dict[tuple[int, int], int] = {}
        usable = self._split(ranks)
        # The trie: node 0 is its root; a child is found by (node, byte).
        self._child: dict[int, int] = {}
        self._ends = [_START]  # the token that each node completes, if any
        for rank in usable:
            node = 0
            for byte in self.token_of[rank]:
                key = node << 8 | byte
                if key not in self._child:
                    self._child[key] = len(self._ends)
                    self._ends.append(_START)
                node = self._child[key]
            self._ends[node] = rank
        self._leads = bytearray(len(self._ends))  # does any token go on from here?
        for key in self._child:
            self._leads[key >> 8] = 1
        self._below = self._tails()
        self._right = lru_cache(maxsize=None)(self._right_edge)
        self._left = lru_cache(maxsize=None)(self._left_edge)
        self._joins = lru_cache(maxsize=PAIRS)(self._neighbours)
        self._hopes = lru_cache(maxsize=PAIRS)(self._viable)
        self._forget()

    def _split(self, ranks: dict[bytes, int]) -> list[int]:
        """Find the last merge of every token; returns the tokens that merging can produce.

        By ascending rank: just before a token is made, its bytes are merged by all lower
        ranks, and exactly two tokens have to be left.
        """
        usable = []
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            if len(token) == 1:
                usable.append(rank)
                continue
            left = self._merged(token, ranks, rank)
            if len(left) == 2:
                pair = (ranks[left[0]], ranks[left[1]])
                self._parts[rank] = pair
                self._fused[pair] = rank
                usable.append(rank)
        # Any two tokens whose bytes together are a token merge to it, whatever its own last merge.
        for rank in list(self._parts):
            token = self.token_of[rank]
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    self._fused[a, b] = rank
        return usable

    @staticmethod
    def _merged(piece: bytes, ranks: dict[bytes, int], below: float) -> list[bytes]:
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = min(
                (ranks.get(parts[i] + parts[i + 1], _FOREVER), i) for i in range(len(parts) - 1)
            )
            if best >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _right_edge(self, token: int) -> list[tuple[int, float]]:
        """The tokens that stood at the right end while ``token`` was made, and when each was
        merged away: the whole token never is."""
        edge, gone = [(token, _FOREVER)], token
        while gone in self._parts:
            inner = self._parts[gone][1]
            edge.append((inner, gone))
            gone = inner
        return edge

    def _left_edge(self, token: int) -> list[tuple[int, float]]:
        edge, gone = [(token, _FOREVER)], token
        while gone in self._parts:
            inner = self._parts[gone][0]
            edge.append((inner, gone))
            gone = inner
        return edge

    def _neighbours(self, a: int, b: int) -> bool:
        """Is (a, b) the encoding of its bytes? Not if at some time the tokens that face each
        other would merge before either is merged on its own side."""
        facing_a, facing_b = self._right(a), self._left(b)
        i, j = len(facing_a) - 1, len(facing_b) - 1
        while True:
            (left, left_goes), (right, right_goes) = facing_a[i], facing_b[j]
            fused = self._fused.get((left, right), _FOREVER)
            # Of equal ranks the leftmost merge comes first.
            if fused < left_goes and fused <= right_goes and fused != _FOREVER:
                return False
            if i == 0 and j == 0:
                return True
            if j == 0 or (i > 0 and left_goes <= right_goes):
                i -= 1
            else:
                j -= 1

    def _tails(self) -> list[list[int] | None]:
        """For every trie node the tokens that go on from it, or None where they are many."""
        below: list[list[int] | None] = [[] for _ in self._ends]
        # A child is numbered after its parent, so children are done before their parents.
        for key, child in reversed(self._child.items()):
            parent, own = below[key >> 8], below[child]
            if parent is None:
                continue
            if own is None or len(parent) + len(own) >= MANY:
                below[key >> 8] = None
                continue
            parent.extend(own)
            if self._ends[child] != _START:
                parent.append(self._ends[child])
        return below

    def _viable(self, token: int, node: int) -> bool:
        """Can any token that goes on from ``node`` follow ``token``? If not, the hypothesis
        need not be carried along."""
        below = self._below[node]
        return below is None or any(self._joins(token, tail) for tail in below)

    def _forget(self) -> None:
        self._known: dict[tuple, dict] = {}
        self._start = self._enter((_START, (((), 0),)))

    def _enter(self, meaning: tuple) -> dict:
        """The state of that meaning: a table from bytes to (next state, emitted tokens)."""
        state = self._known.get(meaning)
        if state is None:
            state = self._known[meaning] = {_MEANING: meaning}
        return state

    def _advance(self, meaning: tuple, byte: int) -> tuple[dict, tuple[int, ...]]:
        """Work out a transition: the next state, and the tokens that are now certain.

        A state means (last emitted token, hypotheses); a hypothesis is (tokens since then,
        trie node of the bytes after them). The complete prefix is the one at the root.
        """
        last, hypotheses = meaning
        moved, complete = [], None
        for path, node in hypotheses:
            ahead = self._child.get(node << 8 | byte)
            if ahead is None:
                continue
            previous = path[-1] if path else last
            if self._leads[ahead] and (previous == _START or self._hopes(previous, ahead)):
                moved.append((path, ahead))
            token = self._ends[ahead]
            if token != _START and complete is None and (previous == _START or self._joins(previous, token)):
                complete = (*path, token)
        moved.append((complete, 0))
        first = moved[0][0]  # of the oldest prefix, so mostly the shortest
        if not first:
            return self._enter((last, tuple(moved))), first
        common = len(first)
        for path, _ in moved[1:]:
            k = 0
            while k < common and k < len(path) and path[k] == first[k]:
                k += 1
            common = k
        emitted = first[:common]
        target = (emitted[-1] if emitted else last, tuple([(path[common:], node) for path, node in moved]))
        return self._enter(target), emitted

    def encode(self, piece: bytes) -> list[int]:
        """The token ids of one pre-token, read byte by byte."""
        if len(self._known) > self.limit:
            self._forget()
        ids: list[int] = []
        state = self._start
        for byte in piece:
            found = state.get(byte)
            if found is None:
                found = state[byte] = self._advance(state[_MEANING], byte)
            state, emitted = found
            if emitted:
                ids.extend(emitted)
        # At the end only the hypothesis with no bytes left over is right.
        ids.extend(state[_MEANING][1][-1][0])
        return ids


class Utf8Stream:
    """An incremental UTF-8 reader: characters that are complete come out, the bytes of
    one that is not are held back. Bytes that can be no character become U+FFFD."""

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """How many bytes at the end may begin a character that has yet to be completed."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte < 0x80:
                return 0
            if byte >= 0xC0:
                wanted = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return back if back < wanted and byte < 0xF8 else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data) - self._unfinished(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


class Codec:
    """Texts to ids and back, by the transducer."""

    def __init__(self, ranks: bytes, pattern: str):
        self.transducer = Transducer(read_ranks(ranks))
        self.split = splitter(pattern)
        self._of = Memo(self._work, MEMO)

    def _work(self, piece: str) -> tuple[int, ...]:
        return tuple(self.transducer.encode(piece.encode()))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self._of.__getitem__, self.split(text))))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.transducer.token_of.__getitem__, ids))

    def decode_stream(self, chunks: Iterable[list[int]]) -> Iterator[str]:
        """Text as ids come in: each character once all its bytes are there."""
        stream = Utf8Stream()
        for ids in chunks:
            yield stream.feed(self.decode(ids))
        yield stream.end()


@lru_cache(maxsize=4)
def codec(ranks: bytes, pattern: str) -> Codec:
    """One codec per Python worker, kept for its later tasks."""
    made = Codec(ranks, pattern)
    few_collections()
    return made


IDS_AT_ONCE = 1 << 14


def _digests(batches: Iterator[pa.RecordBatch], ranks: bytes, pattern: str) -> Iterator[pa.RecordBatch]:
    own = codec(ranks, pattern)
    for batch in batches:
        counts, of_ids, of_text = [], [], []
        for text in batch.column("text").to_pylist():
            ids = own.encode(text or "")
            counts.append(len(ids))
            of_ids.append(hashlib.sha256(str(ids)[1:-1].replace(" ", "").encode()).hexdigest())
            back = hashlib.sha256()
            chunks = (ids[i : i + IDS_AT_ONCE] for i in range(0, len(ids), IDS_AT_ONCE))
            for part in own.decode_stream(chunks):
                back.update(part.encode())
            of_text.append(back.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def _encoded(batches: Iterator[pa.RecordBatch], ranks: bytes, pattern: str) -> Iterator[pa.RecordBatch]:
    own = codec(ranks, pattern)
    for batch in batches:
        ids = [own.encode(text or "") for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
        )


def _decoded(batches: Iterator[pa.RecordBatch], ranks: bytes, pattern: str) -> Iterator[pa.RecordBatch]:
    own = codec(ranks, pattern)
    for batch in batches:
        texts = ["".join(own.decode_stream([ids or []])) for ids in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``(doc_id, ids)`` of ``docs(doc_id, text, ...)``, one row per row, without a shuffle.

    ``ranks`` is the content of a rank file (about a megabyte, sent along with the tasks). A null
    or empty text has no ids; a null id is passed on; other columns are not looked at.
    """
    return _texts(docs).mapInArrow(partial(_encoded, ranks=ranks, pattern=pattern), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``(doc_id, text)`` of ``encoded(doc_id, ids)``; null or no ids give an empty text."""
    return encoded.select("doc_id", "ids").mapInArrow(
        partial(_decoded, ranks=ranks, pattern=pattern), "doc_id long, text string"
    )


def round_trip(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: the digest of each text's ids, and
    that of the text decoded from them as a stream. One row per row of ``docs``; a null text
    counts as empty; other columns are not looked at."""
    return _texts(docs).mapInArrow(partial(_digests, ranks=ranks, pattern=pattern), SCHEMA)
