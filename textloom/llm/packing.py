"""Packing by concatenating and cutting.

Pass one gives every document its ids and its place within its partition; the partitions'
token totals, summed in order, give each partition its place in the whole. Pass two cuts the
concatenation at multiples of the window: a document that crosses a boundary leaves one
record on either side. Only the last window is not full, so padding is less than one window.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from tokenizers import Tokenizer

from textloom.llm.pretokens import PIECE, Memo, few_collections, gives_back, in_pieces, one_held, splitter
from textloom.llm.token_count import LETTERS
from textloom.operators.joins import fits_broadcast
from textloom.session import batches_of, materialize

WINDOW = 2048
END_ID = 1
MEMO = 1 << 18
ID_BYTES = 4

PLACED = "doc_id long, ids binary, n long, part long, at long"


class WordEncoder:
    """Ids of a word-wise vocabulary, each different word being encoded once.

    The file's own steps are kept: special strings are cut out first, then text is put
    into NFC and lower case, split into words, and each word goes through the file's model. The
    constructor refuses a file that is built otherwise.
    """

    def __init__(self, content: bytes):
        spec = json.loads(content)
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        cuts = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
            raise ValueError("not a word-wise lower-case vocabulary")
        self.model = Tokenizer.from_str(content.decode()).model
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len)[::-1])) + ")")
        self.split = splitter(cuts[0]["pattern"]["Regex"])
        self.letters = dict(enumerate(LETTERS))
        self.ids_of = Memo(self._word, MEMO)

    def _word(self, word: str) -> bytes:
        shown = word.encode().decode("latin-1").translate(self.letters)
        ids = [token.id for token in self.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            # Lower case letter by letter: the sigma at a word's end is like any other.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return b"".join(map(self.ids_of.__getitem__, self.split(text.lower())))

    def __call__(self, text: str) -> bytes:
        """The ids of a text, four little-endian bytes each."""
        if not self.special or not self.at_special.search(text):
            return self._plain(text)
        return b"".join(
            np.uint32(self.special[part]).tobytes() if part in self.special else self._plain(part)
            for part in self.at_special.split(text)
        )


@one_held
def word_encoder(content: bytes) -> WordEncoder:
    """One encoder per Python worker, kept for its later tasks."""
    made = WordEncoder(content)
    few_collections()
    return made


@gives_back
def _place(
    batches: Iterator[pa.RecordBatch], make: Callable[[], Callable[[str], bytes]], end: bytes
) -> Iterator[pa.RecordBatch]:
    """A partition's documents with their ids and their place among the partition's ids."""
    encode, part, at = make(), TaskContext.get().partitionId(), 0
    for batch in in_pieces(batches):
        ids = [encode(text or "") + end for text in batch.column("text").to_pylist()]
        sizes = np.array([len(x) // ID_BYTES for x in ids], np.int64)
        starts = at + np.cumsum(sizes) - sizes
        at += int(sizes.sum())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(ids, pa.binary()),
                pa.array(sizes),
                pa.array(np.full(len(ids), part, np.int64)),
                pa.array(starts),
            ],
            ["doc_id", "ids", "n", "part", "at"],
        )


def packed(
    docs: DataFrame, make: Callable[[], Callable[[str], bytes]], window: int = WINDOW, end_id: int = END_ID
) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids)``: one row per
    piece of a document of ``docs(doc_id, text, ...)`` within a window.

    ``make`` gives, on a worker, the function from text to ids as bytes. Each document is
    followed by ``end_id``, so a null or empty text is that id alone. Documents come in the
    order of their partition, so sequences differ from run to run if the partitions
    do; ids that are null or repeat are packed like any others. No rows give no pieces. Other
    columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    end = np.uint32(end_id).tobytes()
    # Written, so that the places are fixed once and for all.
    with batches_of(docs.sparkSession, PIECE):  # of whole texts
        placed = materialize(rows.mapInArrow(partial(_place, make=make, end=end), PLACED), "placed")
    # One row per partition of the input, however long the documents: 16 bytes for each.
    totals = placed.groupBy("part").agg(F.sum("n").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    if fits_broadcast(offsets):
        offsets = F.broadcast(offsets)
    return pieces(placed.join(offsets, "part").withColumn("at", F.col("at") + F.col("_before")), window)


def pieces(placed: DataFrame, window: int = WINDOW) -> DataFrame:
    """Cut ``placed(doc_id, ids, n, at)``, with places in the whole, at the window's multiples."""
    first, last = F.floor(F.col("at") / window), F.floor((F.col("at") + F.col("n") - 1) / window)
    k, at = F.col("sequence_id"), F.col("at")
    start = F.greatest(k * window - at, F.lit(0).cast("long"))
    stop = F.least((k + 1) * window - at, F.col("n"))
    # Numbers unfold first and ids are cut from the row as it stands, so both are in generated code:
    # what an expression over arrays makes for every piece fills the heap faster than it is emptied.
    cut = F.substring("ids", (F.col("start") * ID_BYTES + 1).cast("int"), (F.col("length") * ID_BYTES).cast("int"))
    return (
        placed.withColumn("sequence_id", F.explode(F.sequence(first, last)))
        .select(
            "doc_id", start.alias("start"), (stop - start).alias("length"), F.col("n").alias("doc_tokens"),
            "sequence_id", (at + start - k * window).alias("offset"), "ids",
        )
        .select("doc_id", "start", "length", F.crc32(cut).alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", cut.alias("ids"))
    )


def sequences(pieces_of: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the windows themselves, put together from their pieces. A window
    has at most its own length of ids, so its group is bounded."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(
        parts, F.lit(b"").cast("binary"), lambda whole, part: F.concat(whole, part["ids"])
    )
    return pieces_of.groupBy("sequence_id").agg(joined.alias("ids"))
