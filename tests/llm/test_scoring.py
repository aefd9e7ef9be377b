"""Language, licenses, search and URL filters against brute force and hand-made cases."""

import random
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import language_id, license_scan, topk_search, url_filter
from textloom.llm.queries import RULES
from textloom.llm.url_filter import Rule

FOLDER = "/root/testdata/sf0.01"

# Languages


def brute_phrases(text, known):
    """Greedy parsing by looking for the longest match in the known string."""
    phrases = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in known:
            size += 1
        at += size
        phrases += 1
    return phrases


def test_automaton_parses_as_brute_force():
    draw = random.Random(1)
    for _ in range(30):
        known = [draw.randrange(4) for _ in range(draw.randint(1, 200))]
        table = language_id.automaton(known, 4)
        text = [draw.randrange(4) for _ in range(draw.randint(1, 100))]
        state, missed = 0, 0
        for kind in text:
            ahead = int(table[state, kind])
            missed += ahead >= language_id._MISS
            state = ahead & int(language_id._STATE)
        letters = "".join(map(str, known))
        # A symbol the string does not hold is a phrase alone, and the next one begins behind it.
        if set(text) <= set(known):
            assert missed + 1 == brute_phrases("".join(map(str, text)), letters)


def test_letters_beyond_the_table_parse_as_brute_force():
    """More kinds of letters than a table has columns, and some that the text does not hold."""
    draw = random.Random(4)
    kinds = 400
    for size in (5, 300, 3000):
        known = [draw.randrange(kinds - 50) for _ in range(size)]
        own = language_id.Automaton(np.array(known), kinds)
        letters = "".join(chr(0x4E00 + kind) for kind in known)
        for _ in range(10):
            text = []
            while len(text) < 200:
                at = draw.randrange(size)
                text += known[at : at + draw.randint(1, 9)] + [draw.randrange(kinds)] * draw.randint(0, 1)
            state, missed = np.zeros(1, np.int32), 0
            for kind in text:
                given = np.array([kind])
                ahead = own.steps(state, own.column[given], given)
                missed += int(ahead[0] >= language_id._MISS)
                state = ahead & language_id._STATE
            # A phrase grows while the known text holds it; a letter it does not hold ends one and begins none.
            want, phrase = 0, ""
            for letter in (chr(0x4E00 + kind) for kind in text):
                if phrase + letter in letters:
                    phrase += letter
                else:
                    want, phrase = want + 1, letter if letter in letters else ""
            assert missed == want


def test_rarer_scripts_are_told_apart(spark):
    """Languages of one script whose letters are not among the most frequent ones of all."""
    draw = random.Random(5)

    def made(first, n, words, length):
        known = ["".join(chr(first + draw.randrange(n)) for _ in range(draw.randint(2, 5))) for _ in range(60)]
        return lambda size: " ".join(draw.choices(known, k=size))

    scripts = {"en": (0x61, 26), "ru": (0x430, 32), "el": (0x3B1, 24), "zh": (0x4E00, 900), "ja": (0x4E00, 900), "ko": (0xAC00, 900)}
    makers = {lang: made(*place, 60, 5) for lang, place in scripts.items()}
    training = {lang: make(4000 if lang in ("en", "ru") else 400) for lang, make in makers.items()}
    rows = [(i, makers[lang](12), lang) for i, lang in enumerate(sorted(makers) * 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.languages(docs, training).collect()}
    assert found == {i: lang for i, _, lang in rows}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    training = language_id.training_texts(docs.where(~language_id.held_out()).select("doc_id", "text", "lang"))
    assert all(len(text) <= language_id.TRAINING_CHARS for text in training.values())
    found = language_id.languages(docs, training).where(language_id.held_out())
    known = docs.select("doc_id", "lang")
    right = found.join(known, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98
    assert found.where("score < 0 or score > 1").count() == 0


def test_language_of_odd_rows(spark):
    training = {"aa": "the cat sat on the mat and the dog " * 20, "bb": "der hund und die katze sind nicht da " * 20}
    rows = [
        (1, "the dog and the cat"), (2, "die katze und der hund"), (3, None), (4, ""), (5, "12 34 !!"), (None, "der hund"),
        (1, "the dog and the cat"), (6, "the cat sat on " * 5000), (7, "中文字"),
    ]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in rows], "doc_id bigint, text string, score double")
    found = [tuple(row)[:2] for row in language_id.languages(docs, training).collect()]
    assert sorted(found[:6] + found[6:8], key=str) == sorted(
        [(1, "aa"), (2, "bb"), (3, "und"), (4, "und"), (5, "und"), (None, "bb"), (1, "aa"), (6, "aa")], key=str
    )
    assert found[8] == (7, "aa")  # equally many phrases: the first language
    assert language_id.languages(docs, {}).select("lang_pred").distinct().collect()[0][0] == "und"
    assert language_id.languages(docs.limit(0), training).count() == 0


def test_training_without_labels(spark):
    none = spark.createDataFrame([(1, "text", None), (2, None, "aa")], "doc_id bigint, text string, lang string")
    assert language_id.training_texts(none) == {}


# Licenses


def brute_license(text, notice, similarity):
    import re

    def runs(value):
        found = [w for w in re.split(r"[\W_]+", (value or "").lower()) if w]
        return [tuple(found[i : i + 5]) for i in range(len(found) - 4)]

    wanted, own = runs(notice), runs(text)
    best = None
    for at in range(len(own)):
        if own[at] in set(wanted):
            held = len(set(own[at : at + len(wanted)]) & set(wanted))
            if best is None or held > best[1]:
                best = (at, held)
    return best if best and best[1] >= similarity * len(set(wanted)) else None


def test_license_scan(spark):
    draw = random.Random(2)
    names = list(license_scan.TEMPLATES)
    rows = [(1000, None), (1001, ""), (1002, "too short"), (None, license_scan.TEMPLATES["mit"]), (1003, "word " * 5000)]
    for i in range(150):
        parts = [" ".join(draw.choices(["one", "two", "three", "license", "the", "version"], k=draw.randint(0, 60)))]
        for name in draw.sample(names, draw.randint(0, 2)):
            notice = license_scan.TEMPLATES[name]
            if draw.random() < 0.3:
                notice = notice.replace("License", "LICENSE ").replace(",", " ,")
            parts += [notice, " ".join(draw.choices(["more", "words", "here"], k=draw.randint(0, 9)))]
        rows.append((i, " ".join(parts)))
    rows.append(rows[-1])
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, license string")
    found = {(r["doc_id"], r["license"]): (r["first_word"], r["matched"]) for r in license_scan.scan(docs).collect()}
    want = {}
    for i, text in rows:
        for name, notice in license_scan.TEMPLATES.items():
            if i is not None and (hit := brute_license(text, notice, license_scan.SIMILARITY)):
                want[i, name] = hit
    assert found == want
    assert len(want) > 80


def test_license_families(spark):
    """Headers and texts of the usual families, wrapped as in source files, and notices with another word."""
    def wrapped(name):
        return "# Copyright 2020 Someone\n# " + "\n# ".join(textwrap.wrap(license_scan.TEMPLATES[name], 50)) + "\n# more"

    long = [name for name in license_scan.TEMPLATES if name.endswith(("-header", "-text"))]
    want = {i: name for i, name in enumerate(sorted(long))}
    rows = [(i, wrapped(name)) for i, name in want.items()]
    notices = {
        "This code is licensed under the MIT License, see above.": "mit-licensed",
        "It may be used under the terms of the MIT license": "mit-terms",
        "This book is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa-4.0-name",
        "Texts: licensed under CC BY-SA 4.0": "cc-by-sa-4.0",
        "released under the GNU General Public License, version 2": "gpl-2.0-name",
        "see the GNU Affero General Public License version 3": "agpl-3.0-name",
        "subject to the Mozilla Public License, version 2.0": "mpl-2.0-name",
    }
    rows += [(100 + i, text) for i, text in enumerate(notices)]
    want |= {100 + i: name for i, name in enumerate(notices.values())}
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    best = {(r["doc_id"], r["license"]): r["containment"] for r in found}
    assert {i for i, name in want.items() if best.get((i, name)) != 1.0} == set()
    families = {name.split("-")[0] for name in want.values()}
    assert {"gpl", "lgpl", "agpl", "mpl", "cc", "cc0", "unlicense", "mit", "bsd", "apache", "isc", "zlib"} <= families
    # A notice of one version is none of another.
    assert (104, "gpl-3.0-name") not in best


def test_edited_notices_are_found(spark):
    """Words deleted, replaced and added at random: all that holds enough of a template is found."""
    draw = random.Random(11)
    names, rows = sorted(license_scan.TEMPLATES), []

    def edited(words, rate):
        for word in words:
            kind = draw.random() / rate
            if kind < 1 / 3:
                continue
            yield f"x{draw.randrange(10**6)}" if kind < 2 / 3 else word
            if 2 / 3 <= kind < 1:
                yield f"y{draw.randrange(10**6)}"

    for i in range(160):
        body = [f"w{draw.randrange(5000)}" for _ in range(draw.randint(0, 150))]
        at = draw.randint(0, len(body))
        notice = license_scan.TEMPLATES[names[i % len(names)]].split()
        rows.append((i, " ".join([*body[:at], *edited(notice, draw.choice([0.01, 0.02, 0.04, 0.06])), *body[at:]])))
    want = {
        (i, name): hit
        for i, text in rows
        for name, notice in license_scan.TEMPLATES.items()
        if (hit := brute_license(text, notice, license_scan.SIMILARITY))
    }
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r["doc_id"], r["license"]): (r["first_word"], r["matched"]) for r in license_scan.scan(docs).collect()}
    assert set(found) <= set(want)
    assert len(want) > 120 and len(found) >= 0.99 * len(want)


def test_bands_are_independent(spark):
    """Windows alike by one half meet in about half of the bands, wherever their shingles stand."""
    rows = [(i, list(range(1000 * i, 1000 * i + 30)), list(range(1000 * i + 10, 1000 * i + 40))) for i in range(100)]
    pairs = spark.createDataFrame(rows, "i bigint, a array<bigint>, b array<bigint>")
    signed = pairs.select(*(license_scan.signature(F.col(name), 12).alias(name) for name in "ab"))
    met = [sum(x == y for x, y in zip(row["a"], row["b"])) for row in signed.collect()]
    assert 5 < np.mean(met) < 7
    assert min(met) >= 1


def test_license_scan_refuses_short_templates(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    with pytest.raises(ValueError, match="under 5 words"):
        license_scan.scan(docs, {"short": "two words"})
    assert license_scan.scan(docs.limit(0)).count() == 0


# Search


def brute_top(vectors, k):
    whole = {i: [int(np.floor(64.0 * x)) for x in v] for i, v in vectors}
    out = []
    for q in whole:
        if q % 20 == 0:
            products = {i: sum(a * b for a, b in zip(whole[q], v)) for i, v in whole.items() if i != q and len(v) == len(whole[q])}
            # A product beyond a long counts as the nearest long.
            scored = sorted((-min(max(s, -(2**63)), 2**63 - 1), i) for i, s in products.items())
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e7, 1e18, 1e300])
def test_top_k(spark, monkeypatch, scale):
    monkeypatch.setattr(topk_search, "CANDIDATES", 64)
    monkeypatch.setattr(topk_search, "QUERIES", 8)
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(5, 24))
    rows = [(i, [float(x) for x in (centres[i % 5] + draw.normal(size=24) * 0.2) * scale]) for i in range(300)]
    rows += [(400 + i, rows[20][1]) for i in range(40)]  # many equal vectors: ties
    odd = [(900, None), (920, [None] * 24), (940, [float("nan")] * 24), (960, [float("inf")] * 24), (None, rows[0][1])]
    docs = spark.createDataFrame([(i, v, 1) for i, v in [*rows, *odd, rows[0]]], "vec_id bigint, embedding array<double>, rank int")
    found = topk_search.top_k(docs, F.col("vec_id") % 20 == 0).collect()
    assert sorted(tuple(row) for row in found) == brute_top(rows, 20)


def test_top_k_of_few(spark):
    rows = [(0, [1.0]), (20, [2.0]), (3, [1.0, 2.0])]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = sorted(tuple(r) for r in topk_search.top_k(docs, F.col("vec_id") % 20 == 0).collect())
    assert found == [(0, 1, 20, 64 * 128), (20, 1, 0, 64 * 128)]
    assert topk_search.top_k(docs.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# URL filters


def test_rules(spark):
    urls = {
        "http://Sub.Example.ORG/es/x?y#z": ("sub.example.org", "/es/x", "example.org/es/", "block"),
        "https://example.org/en/17": ("example.org", "/en/17", "example.org/en/1", "block"),
        "https://example.org/en/27": ("example.org", "/en/27", "org/", "allow"),
        "https://a.com/fr/": ("a.com", "/fr/", "com/fr/", "allow"),
        "https://a.com/de/1": ("a.com", "/de/1", "com/de/", "block"),
        "https://acom/de/1": ("acom", "/de/1", None, None),
        "ftp://b.net?x=://c.org/": ("b.net", "", None, None),
        "no scheme": ("", "", None, "allow"),
        "x://": ("", "", None, "allow"),
        "http://org": ("org", "", None, None),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, None, "x") for i, u in enumerate(urls)], "page_id bigint, url string, html string, host string")
    found = {r["page_id"]: r for r in url_filter.url_verdicts(pages, RULES).collect()}
    for i, (host, path, rule, verdict) in enumerate(urls.values()):
        row = found[i]
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == (verdict or row["verdict"])


def test_distrust_runs_against_links_and_trust_along_them(spark):
    rules = (Rule("allow", "good.org", "/"), Rule("block", "bad.org", "/"))
    link = '<a class="x" href="{}">t</a>'
    pages = [
        (1, "http://good.org/", link.format("https://friend.net/a") + link.format("/own")),
        (2, "http://bad.org/", ""),
        (3, "http://spam.net/x", link.format("http://bad.org/1") + link.format("//bad.org/2")),
        (4, "http://friend.net/", "<a href=http://other.net>t</a>"),
        (5, "http://farm.net/", link.format("http://spam.net/")),
        (6, "http://lonely.net/", None),
    ]
    docs = spark.createDataFrame([*pages, pages[2]], "page_id bigint, url string, html string")
    found = {r["page_id"]: r for r in url_filter.url_verdicts(docs, rules).collect()}
    assert [found[i]["verdict"] for i in range(1, 7)] == ["allow", "block", "block", "allow", "block", "allow"]
    assert found[4]["trust"] > 0 and found[4]["distrust"] == 0
    assert found[3]["distrust"] > found[5]["distrust"] > 0
    assert url_filter.url_verdicts(docs.limit(0), rules).count() == 0


def test_only_addresses_are_links(spark):
    html = """<a href="http://one.org/">x</a><a\nclass=q  href = 'https://two.org/a'>y</a><A data-href="http://three.org/">z</A>
        <a title="t" data-href='http://four.org' href=//five.org>v</a><area href="http://six.org/"><a nohref="http://seven.org/">"""
    pages = spark.createDataFrame([(1, "http://own.org/", html)], "page_id bigint, url string, html string")
    assert {r["dst"] for r in url_filter.host_links(pages).collect()} == {"one.org", "two.org", "five.org"}


def test_ranks_against_brute_force(spark):
    draw = random.Random(6)
    edges = sorted({(f"h{draw.randrange(12)}", f"h{draw.randrange(12)}") for _ in range(40)})
    edges = [(a, b, draw.randint(1, 3)) for a, b in edges if a != b]
    seeds = {"h1": 2.0, "h4": 1.0}
    out = {}
    for a, _, n in edges:
        out[a] = out.get(a, 0) + n
    mass = start = {h: m / 3 for h, m in seeds.items()}
    for _ in range(5):
        after = {h: 0.15 * m for h, m in start.items()}
        for a, b, n in edges:
            if a in mass:
                after[b] = after.get(b, 0.0) + 0.85 * mass[a] * n / out[a]
        mass = after
    found = url_filter.spread(
        spark.createDataFrame(edges, "src string, dst string, n bigint"),
        spark.createDataFrame(list(seeds.items()), "host string, mass double"),
        rounds=5,
    )
    assert {r["host"]: pytest.approx(r["mass"]) for r in found.collect()} == mass


def test_small_blocked_hosts_beside_a_hot_one(spark):
    """A blocked host with a minute share of all blocked pages blocks its other pages, and who links to it."""
    rules = (Rule("block", "hot.org", "/"), Rule("block", "small.net", "/bad/"), Rule("allow", "good.org", "/"))
    edges = spark.createDataFrame([("fan.net", "small.net", 1), ("farm.net", "fan.net", 1)], "src string, dst string, n bigint")
    seeds = spark.createDataFrame([("hot.org", 1e12), ("small.net", 1.0)], "host string, mass double")
    against = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    mass = url_filter.spread(against, seeds)
    assert {"fan.net", "farm.net"} <= {r["host"] for r in mass.where("mass > 0").collect()}
    scores = mass.select("host", F.lit(0.0).alias("trust"), F.col("mass").alias("distrust"))
    pages = spark.createDataFrame(
        [(1, "http://small.net/x", ""), (2, "http://fan.net/", ""), (3, "http://farm.net/", ""), (4, "http://else.net/", "")],
        "page_id bigint, url string, html string",
    )
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(url_filter, "host_scores", lambda *given: scores)
        found = {r["page_id"]: r for r in url_filter.url_verdicts(pages, rules).collect()}
    assert [found[i]["verdict"] for i in range(1, 5)] == ["block", "block", "block", "allow"]
    assert 0 < found[3]["distrust"] < found[2]["distrust"] < 1e-12


def test_distrust_reaches_far_hosts(spark):
    """A chain of twelve links to a blocked host, with a cycle at its end."""
    rules = (Rule("block", "h0.net", "/"),)
    link = '<a href="http://h{}.net/">t</a>'
    pages = [(i, f"http://h{i}.net/", link.format(i - 1)) for i in range(1, 13)]
    pages += [(0, "http://h0.net/", ""), (13, "http://h13.net/", link.format(12) + link.format(14)), (14, "http://h14.net/", link.format(13))]
    docs = spark.createDataFrame([*pages, (99, "http://alone.net/", "")], "page_id bigint, url string, html string")
    found = {r["page_id"]: r for r in url_filter.url_verdicts(docs, rules).collect()}
    assert {i for i, r in found.items() if r["verdict"] == "block"} == set(range(15))
    # Against links: h13 hands all of its mass to h14, and h14 all of its own back.
    reached = 0.15 * 0.85**12
    assert found[12]["distrust"] == pytest.approx(reached, rel=1e-6)
    assert found[13]["distrust"] == pytest.approx(reached * 0.85 / (1 - 0.85**2), rel=1e-6)
