"""Text functions: Column in, Column out.

All of them are built-in expressions, evaluated row by row without a shuffle. The
patterns are written for Java regular expressions but, except for ALNUM and CUTS, keep to
syntax that RE2 reads the same way, so the twins in ``plans.oracle`` use these constants.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]+"
TERM = r"[\p{L}\p{N}_]{2,}"
# Fixed value: letters kept by the summariser and the language detector.
ALPHABET = "a-zа-яё"
# Characters Python takes for white space, as the inside of a character class.
SPACE = r"\t-\r\x{1C}-\x{20}\x{85}\p{Z}"
NON_SPACE = rf"[^{SPACE}]+"
# A word with white space or nothing on both sides that is wholly alphanumeric.
ALNUM = rf"(?<![^{SPACE}])[\p{{L}}\p{{N}}]++(?![^{SPACE}])"
EDGE_SPACE = rf"^[{SPACE}]+|[{SPACE}]+\z"
# A sentence ends with . ! or ?, any closing marks, and white space.
SENTENCE_END = rf"([.!?][\"')\]}}]*)[{SPACE}]+"
MARK = "\u0001"
# The same place, its white space kept with what stands before it.
SPACED_END = rf"([.!?][\"')\]}}]*[{SPACE}]+)"
# A piece between white space: its word, and whether just one period ends it.
CORE = r"^[^\p{L}\p{N}]*([\p{L}\p{N}](?:.*[\p{L}\p{N}])?)"
DOTTED = r"[\p{L}\p{N}]\.[\"')\]}]*\z"
LAST_PIECE = rf"([^{SPACE}]+)[{SPACE}]*\z"

# Where a Penn-Treebank tokenizer separates tokens, in order of application.
FINAL_PERIOD = rf"([^.])\.([\"')\]}}>»”’]*)([{SPACE}]+|\z)"
SEPARATORS = r"[\[\](){}<>«»“”„‘’`\"?!;@#$%&*]|--|\.\.+|''"
SOFT_SEPARATORS = r"[:,]([^\p{Nd}]|\z)"
CONTRACTION_TAILS = rf"('[sSmMdD]|'ll|'LL|'re|'RE|'ve|'VE|n't|N'T|')([{SPACE}]|\z)"
# Words the same tokenizer cuts in two after the third letter.
CUT_WORDS = ("cannot", "gimme", "gonna", "gotta", "lemme", "wanna")
CUTS = (
    rf"(?<![^{SPACE}])(?i:("
    + "|".join(f"{word[:3]}(?={word[3:]}(?![^{SPACE}]))" for word in CUT_WORDS)
    + "))"
)

Tokens = Callable[[Column], Column]


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once instead of once per use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def find_all(text: Column | str, pattern: str) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(pattern), F.lit(0))


def strip(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), EDGE_SPACE, "")


def line(text: Column | str, number: int) -> Column:
    """The ``number``-th line, stripped; empty where the text has fewer lines."""
    lines = F.split(_col(text), r"\r\n|\r|\n", number + 1)
    return strip(F.coalesce(F.get(lines, F.lit(number - 1)), F.lit("")))


def normalize_letters(text: Column | str, alphabet: str = ALPHABET) -> Column:
    """Lower-cased runs of letters of ``alphabet``; every other character separates."""
    return find_all(F.lower(_col(text)), f"[{alphabet}]+")


def tokenize_words(text: Column | str) -> Column:
    """Lower-cased words: runs of letters, digits and underscores."""
    return find_all(F.lower(_col(text)), WORD)


def tokenize_terms(text: Column | str) -> Column:
    """Words of two or more characters, the tokens of the search index."""
    return find_all(F.lower(_col(text)), TERM)


def split_words(text: Column | str) -> Column:
    """Pieces between white space, case and punctuation kept."""
    return find_all(text, NON_SPACE)


def remove_stop_words(words: Column | str, stop_words: Iterable[str]) -> Column:
    """Drop listed words; order and duplicates stay."""
    listed = list(stop_words)
    return F.filter(_col(words), lambda word: ~word.isin(listed))


def tokenize_alnum(text: Column | str, stop_words: Iterable[str]) -> Column:
    """Treebank-like tokens that are wholly alphanumeric and not stop words; case kept.

    Stop words are compared case-sensitively, so ``The`` stays where ``the`` goes.
    """
    spaced = F.regexp_replace(_col(text), FINAL_PERIOD, "$1 $2 ")
    spaced = F.regexp_replace(spaced, SEPARATORS, " ")
    spaced = F.regexp_replace(spaced, SOFT_SEPARATORS, " $1")
    spaced = F.regexp_replace(spaced, "(?=['nN])" + CONTRACTION_TAILS, " ")
    spaced = F.regexp_replace(spaced, CUTS, "$1 ")
    return remove_stop_words(find_all(spaced, ALNUM), stop_words)


def split_sentences(text: Column | str) -> Column:
    """Ordered sentences; line feeds inside a sentence are deleted, not replaced."""
    body = F.regexp_replace(_col(text), rf"[{SPACE}]+\z", "")
    pieces = F.split(F.regexp_replace(body, SENTENCE_END, "$1" + MARK), MARK)
    joined = F.transform(pieces, lambda piece: F.replace(piece, F.lit("\n"), F.lit("")))
    return F.filter(joined, lambda sentence: sentence != "")


def spaced_pieces(text: Column | str) -> Column:
    """The text cut behind every mark that may end a sentence and its white space; joined again,
    the pieces are the text without the white space at its end."""
    body = F.regexp_replace(_col(text), rf"[{SPACE}]+\z", "")
    return F.split(F.regexp_replace(body, SPACED_END, "$1" + MARK), MARK)


def word_type(piece: Column) -> Column:
    """The lower-cased word within a piece between white space; empty where it holds none."""
    return F.regexp_extract(F.lower(piece), CORE, 1)


def ngrams(words: Column | str, n: int = 2) -> Column:
    """Every run of ``n`` successive words, joined by one space."""
    return bind(
        _col(words),
        lambda w: F.when(
            F.size(w) >= n,
            F.transform(
                F.sequence(F.lit(1), F.size(w) - (n - 1)),
                lambda i: F.concat_ws(" ", *[F.get(w, i + (k - 1)) for k in range(n)]),
            ),
        ).otherwise(F.array().cast("array<string>")),
    )


def numbered(items: Column | str) -> Column:
    """``array<struct<total, at, item>>``: each item with the length of the array and its
    place from 0. Unfolding this expression, rather than a named array column, keeps
    the optimizer from evaluating the array a second time for a filter on its size."""
    return bind(
        _col(items),
        lambda array: F.transform(
            array,
            lambda item, at: F.struct(
                F.size(array).alias("total"), at.alias("at"), item.alias("item")
            ),
        ),
    )


def spaced_letters(text: Column | str) -> Column:
    """The lower-cased text with single spaces for white space and one more on each side."""
    spaced = F.regexp_replace(F.lower(_col(text)), rf"[{SPACE}]+", " ")
    return F.concat(F.lit(" "), spaced, F.lit(" "))


def char_trigrams(text: Column | str) -> Column:
    """Overlapping character trigrams of the lower-cased text, one space on each side.

    Three passes of adjacent triples, shifted by one, are linear in the text length.
    """
    return bind(
        spaced_letters(text),
        lambda t: F.concat(
            *[find_all(F.substring(t, k, 2147483647), "(?s)...") for k in (1, 2, 3)]
        ),
    )


def _run_starts(ordered: Column, key: Callable[[Column], Column]) -> Column:
    """1-based positions at which the key of a sorted array changes."""
    return F.when(
        F.size(ordered) > 0,
        F.filter(
            F.sequence(F.lit(1), F.size(ordered)),
            lambda i: (i == 1) | (key(F.get(ordered, i - 1)) != key(F.get(ordered, i - 2))),
        ),
    ).otherwise(F.array().cast("array<int>"))


def term_counts(tokens: Column | str) -> Column:
    """``array<struct<term, tf>>``: the distinct tokens with their number, sorted by term.

    Counting runs of the sorted array needs neither a shuffle nor more than
    O(n log n) per document, so postings come out of the scan stage itself.
    """

    def runs(ordered: Column) -> Column:
        def pair(starts: Column) -> Column:
            ends = F.slice(F.concat(starts, F.array(F.size(ordered) + 1)), 2, F.size(starts))
            return F.zip_with(
                starts,
                ends,
                lambda a, b: F.struct(
                    F.get(ordered, a - 1).alias("term"), (b - a).cast("long").alias("tf")
                ),
            )

        return bind(_run_starts(ordered, lambda token: token), pair)

    return bind(F.sort_array(_col(tokens)), runs)


def first_forms(terms: Column | str, words: Column | str) -> Column:
    """``array<struct<term, shown>>``: each term with the first form of it that is not
    lower case among ``words``, or with itself where there is none.

    Terms and forms are sorted together, so a term stands right before its earliest form.
    """
    forms = F.transform(
        F.filter(_col(words), lambda word: F.lower(word) != word),
        lambda form, i: F.struct(
            F.lower(form).alias("term"), (i + 1).alias("place"), form.alias("form")
        ),
    )
    heads = F.transform(
        F.array_distinct(_col(terms)),
        lambda term: F.struct(term.alias("term"), F.lit(0).alias("place"), term.alias("form")),
    )

    def merge(ordered: Column) -> Column:
        shown = F.transform(
            ordered,
            lambda entry, i: F.struct(
                entry["term"].alias("term"),
                F.when(
                    F.get(ordered, i + 1)["term"] == entry["term"],
                    F.get(ordered, i + 1)["form"],
                )
                .otherwise(entry["form"])
                .alias("shown"),
                entry["place"].alias("place"),
            ),
        )
        return F.transform(
            F.filter(shown, lambda entry: entry["place"] == 0),
            lambda entry: F.struct(entry["term"].alias("term"), entry["shown"].alias("shown")),
        )

    return bind(F.sort_array(F.concat(heads, forms)), merge)
