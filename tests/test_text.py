import collections
import html as html_library
from html.parser import HTMLParser
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.functions.html import page_text
from textloom.functions.words import (
    ENGLISH_STOP_WORDS,
    RUSSIAN_STOP_WORDS,
    SUMMARY_STOP_WORDS,
)


def test_normalize_letters(value_of):
    assert value_of(tx.normalize_letters, "Ёлка и 2 ÄPFEL_x, don't") == [
        "ёлка", "и", "pfel", "x", "don", "t",
    ]
    assert value_of(tx.normalize_letters, "") == []
    assert value_of(lambda c: tx.normalize_letters(c, "a-zäöüß"), "ÄPFEL Straße") == [
        "äpfel", "straße",
    ]


def test_words_and_terms(value_of):
    text = "Größe_2 x-ray, Съешь ещё I 42!"
    assert value_of(tx.tokenize_words, text) == re.findall(r"\b\w+\b", text.lower())
    assert value_of(tx.tokenize_terms, text) == re.findall(r"\b\w\w+\b", text.lower())


def test_words_follow_python_on_any_text(spark):
    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.text(alphabet="aZ0_é ßЖё中-.,'\n\t ²", max_size=40), min_size=20, max_size=40))
    def check(texts):
        df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
        got = df.select(
            "i",
            tx.tokenize_words("text").alias("words"),
            tx.split_words("text").alias("pieces"),
            tx.strip("text").alias("stripped"),
            tx.term_counts(tx.split_words("text")).alias("counts"),
            tx.ngrams(tx.split_words("text"), 3).alias("grams"),
        ).collect()
        for row in got:
            text = texts[row["i"]]
            pieces = text.split()
            assert row["words"] == re.findall(r"\w+", text.lower())
            assert row["pieces"] == pieces
            assert row["stripped"] == text.strip()
            assert {c["term"]: c["tf"] for c in row["counts"]} == collections.Counter(pieces)
            assert row["grams"] == [" ".join(pieces[i : i + 3]) for i in range(len(pieces) - 2)]

    check()


def test_stop_words_keep_order_and_duplicates(value_of):
    removed = value_of(
        lambda c: tx.remove_stop_words(tx.split_words(c), ("the", "a")), "the dog a dog The cat"
    )
    assert removed == ["dog", "dog", "The", "cat"]


def test_stop_lists():
    assert len(set(RUSSIAN_STOP_WORDS)) == 151
    assert {"the", "don", "wouldn"} <= set(ENGLISH_STOP_WORDS)
    assert all("'" not in word for word in ENGLISH_STOP_WORDS)
    assert len(set(SUMMARY_STOP_WORDS)) == len(SUMMARY_STOP_WORDS)


def test_tokenize_alnum(value_of):
    def tokens(text):
        return value_of(lambda c: tx.tokenize_alnum(c, ENGLISH_STOP_WORDS), text)

    assert tokens("The dog, the cat; well-known (bird).") == ["The", "dog", "cat", "bird"]
    assert tokens("It costs $5, or 1,000 in all: 3.14") == ["It", "costs", "5"]
    assert tokens("He's sure they'll win; James' dog didn't") == [
        "He", "sure", "win", "James", "dog",
    ]
    assert tokens("Cannot say. I'm gonna go") == ["Can", "say", "I", "gon", "na", "go"]
    assert tokens("«Ёлка» under_score été... fin") == ["Ёлка", "été", "fin"]
    assert tokens("") == []


def test_split_sentences(value_of):
    assert value_of(tx.split_sentences, "One two.\nThree\nfour? (Five!) six.  ") == [
        "One two.", "Threefour?", "(Five!)", "six.",
    ]
    assert value_of(tx.split_sentences, "No end 3.14 here") == ["No end 3.14 here"]
    assert value_of(tx.split_sentences, " \n ") == []


def test_ngrams(value_of):
    def grams(text, n=2):
        return value_of(lambda c: tx.ngrams(tx.split_words(c), n), text)

    assert grams("a b c") == ["a b", "b c"]
    assert grams("a b c", 3) == ["a b c"]
    assert grams("a b", 3) == grams("", 2) == grams("a", 2) == []


def test_char_trigrams(value_of):
    for text in ("Ab\ncd", "", "x", "ab", "smile 😀 now"):
        padded = " " + re.sub(r"\s+", " ", text.lower()) + " "
        expected = sorted(padded[i : i + 3] for i in range(len(padded) - 2))
        assert sorted(value_of(tx.char_trigrams, text)) == expected


def test_term_counts(spark, value_of):
    counts = value_of(lambda c: tx.term_counts(tx.split_words(c)), "b a b c a b")
    assert [tuple(c) for c in counts] == [("a", 2), ("b", 3), ("c", 1)]
    assert value_of(lambda c: tx.term_counts(tx.split_words(c)), "") == []


def test_first_forms(value_of):
    def forms(text):
        return dict(
            tuple(f)
            for f in value_of(
                lambda c: tx.first_forms(
                    F.transform(tx.split_words(c), lambda w: F.lower(w)), tx.split_words(c)
                ),
                text,
            )
        )

    assert forms("dog Dog DOG cat Ärger") == {"dog": "Dog", "cat": "cat", "ärger": "Ärger"}


def test_line(value_of):
    assert value_of(lambda c: tx.line(c, 1), " one \r\n two\nthree") == "one"
    assert value_of(lambda c: tx.line(c, 2), " one \r\n two\nthree") == "two"
    assert value_of(lambda c: tx.line(c, 2), "one") == ""


def test_page_text(value_of):
    page = (
        "<!DOCTYPE html><html><head><title> T &amp; U </title><style>p{}</style>"
        "<script>if (a<b) '</p>'</script></head><body><!-- <p>no</p> --><p>One<b>two</b>\n"
        "</p><template>hidden</template><br/>&lt;three&gt; &#233;&#x1F600; &amp;lt; &#1114112;"
        "</body></html>"
    )
    assert value_of(page_text, page) == "T & U\nOne\ntwo\n<three> é😀 &lt; &#1114112;"
    for reference in ("&copy;", "&middot;", "&quot;", "&euro;", "&#65;", "&#x416;", "&mdash;"):
        assert value_of(page_text, f"<p>a{reference}b") == "a" + html_library.unescape(reference) + "b"


def test_page_text_of_hard_markup(value_of):
    cases = {
        "&eacute;&uuml;&szlig;&ntilde;": "éüßñ",
        "a &amp b &notit; &nosuch; &#0000000233; &#38;lt;": "a & b ¬it; &nosuch; é &lt;",
        '<a title="x > y">link</a>': "link",
        "<a title=it's>link</a><b>next</b>": "link\nnext",
        "<p>shown</p><script>var a = 1;": "shown",
        "<script>var a='<!--';</script><p>shown</p><!-- c -->": "shown",
        "one\u0001two": "onetwo",
        "<a " + "b='c' " * 20_000 + ">long": "long",
    }
    for page, text in cases.items():
        assert value_of(page_text, page) == text


class _Strings(HTMLParser):
    """Strings between tags as the standard library's parser finds them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "template")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "template")

    def handle_data(self, data):
        if not self.hidden and data.strip():
            self.found.append(data.strip())


def test_page_text_of_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    for row in pages.select("html", page_text("html").alias("text")).collect():
        parser = _Strings()
        parser.feed(row["html"] or "")
        parser.close()
        assert (row["text"] or "") == "\n".join(parser.found)
