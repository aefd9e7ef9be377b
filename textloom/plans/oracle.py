"""DuckDB SQL twins of the queries in ``plans.catalog``, over the same tables.

Written as plain relational SQL (unnest, join, window) rather than after the Spark
plans, so that an error in one is not repeated in the other. Patterns, word lists
and parameters are shared.
"""

from __future__ import annotations

from html.entities import html5

from textloom.functions import text as tx
from textloom.functions.words import (
    ENGLISH_STOP_WORDS,
    RUSSIAN_STOP_WORDS,
    SUMMARY_STOP_WORDS,
)
from textloom.operators.boundaries import LEAST, SCORE_DIGITS, THRESHOLD, WITH_PERIOD
from textloom.operators.index import IDS_PER_BLOCK
from textloom.operators.language import SHORT_WORD
from textloom.operators.summarize import KEYWORDS, SUMMARY_SENTENCES, WEIGHT_DIGITS
from textloom.plans import catalog
from textloom.sources import reports


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def among(word: str, words: tuple[str, ...]) -> str:
    return f"{word} IN ({', '.join(lit(w) for w in words)})"


def find(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, {lit(pattern)})"


def replace(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {lit(pattern)}, {by}, 'g')"


def keep(words: str, condition: str) -> str:
    return f"list_filter({words}, lambda x: {condition})"


def strip(text: str) -> str:
    return replace(text, tx.EDGE_SPACE, "''")


def line(text: str, number: int) -> str:
    parts = f"regexp_split_to_array({text}, '\\r\\n|\\r|\\n')"
    return strip(f"coalesce({parts}[{number}], '')")


LETTERS = find("lower(text)", f"[{tx.ALPHABET}]+")
WORDS = find("lower(text)", tx.WORD)
TERMS = find("lower(text)", tx.TERM)
PIECES = find("text", tx.NON_SPACE)
CONTENT = keep(WORDS, f"NOT ({among('x', RUSSIAN_STOP_WORDS)})")
SIGNIFICANT = keep(PIECES, f"NOT ({among('x', SUMMARY_STOP_WORDS)})")

_spaced = replace("text", tx.FINAL_PERIOD, r"'\1 \2 '")
_spaced = replace(_spaced, tx.SEPARATORS, "' '")
_spaced = replace(_spaced, tx.SOFT_SEPARATORS, r"' \1'")
_spaced = replace(_spaced, tx.CONTRACTION_TAILS, "' '")
_whole = keep(find(_spaced, tx.NON_SPACE), "regexp_full_match(x, '[\\p{L}\\p{N}]+')")
_cut = (
    f"flatten(list_transform({_whole}, lambda x: CASE WHEN {among('lower(x)', tx.CUT_WORDS)} "
    "THEN [substring(x, 1, 3), substring(x, 4, 3)] ELSE [x] END))"
)
ALNUM = keep(_cut, f"NOT ({among('x', ENGLISH_STOP_WORDS)})")

_body = replace("text", rf"[{tx.SPACE}]+\z", "''")
_marked = replace(_body, tx.SENTENCE_END, r"'\1' || chr(1)")
SENTENCES = (
    f"list_filter(list_transform(string_split({_marked}, chr(1)), "
    "lambda s: replace(s, chr(10), '')), lambda s: s <> '')"
)


# Abbreviations, and sentences that go on behind them
_share = f"least(greatest(sum(dotted) / sum(dotted + plain), {LEAST}), {1 - LEAST})"
_letters = "length(replace(word, '.', ''))"
ABBREVIATIONS = f"""
    ends AS (SELECT regexp_extract(lower(piece), {lit(tx.CORE)}, 1) AS word, regexp_matches(piece, {lit(tx.DOTTED)}) AS dot
             FROM (SELECT unnest({PIECES}) AS piece FROM documents)),
    counts AS (SELECT word, count(*) FILTER (dot) AS dotted, count(*) FILTER (NOT dot) AS plain
               FROM ends WHERE word <> '' GROUP BY word),
    share AS (SELECT {_share} AS p FROM counts),
    scored AS (
        SELECT word, dotted, plain, round(
                   2 * (dotted * ln({WITH_PERIOD} / p) + plain * ln((1 - {WITH_PERIOD}) / (1 - p)))
                   * exp(-{_letters}) * (1 + length(word) - {_letters}) / pow({_letters}::DOUBLE, plain), {SCORE_DIGITS}) AS score
        FROM counts, share WHERE dotted > 0 AND regexp_matches(word, '\\p{{L}}')),
    known AS (SELECT * FROM scored WHERE score >= {THRESHOLD})"""
_pieces = f"string_split({replace(_body, tx.SPACED_END, r"'\1' || chr(1)")}, chr(1))"
_final = f"regexp_extract(piece, {lit(tx.LAST_PIECE)}, 1)"
TRAINED = f"""
    {ABBREVIATIONS},
    pieces AS (SELECT doc_id, unnest(ps) AS piece, generate_subscripts(ps, 1) AS place
               FROM (SELECT doc_id, {_pieces} AS ps FROM documents)),
    marked AS (SELECT *, regexp_matches({_final}, {lit(tx.DOTTED)})
                      AND regexp_extract(lower({_final}), {lit(tx.CORE)}, 1) IN (SELECT word FROM known) AS goes_on
               FROM pieces),
    numbered AS (SELECT *, place - count(*) FILTER (goes_on) OVER (
                     PARTITION BY doc_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS i
                 FROM marked),
    trained AS (SELECT doc_id, (i - 1)::INTEGER AS i,
                       replace({replace("string_agg(piece, '' ORDER BY place)", rf"[{tx.SPACE}]+\z", "''")}, chr(10), '') AS sentence
                FROM numbered GROUP BY doc_id, i)"""


def words_of(words: str, sep: str = " ") -> str:
    return f"SELECT doc_id, coalesce(array_to_string({words}, {lit(sep)}), '') AS words FROM documents"


def tokens(words: str) -> str:
    """CTE body: one row per token."""
    return f"SELECT doc_id, unnest({words}) AS term FROM documents"


def postings(words: str) -> str:
    """CTEs p (postings), s (document frequencies) and n (number of documents)."""
    return f"""
    p AS (SELECT doc_id, term, count(*) AS tf FROM ({tokens(words)}) GROUP BY ALL),
    s AS (SELECT term, count(*) AS df FROM p GROUP BY term),
    n AS (SELECT count(*) AS n FROM documents)"""


# Page text

# Patterns of its own: hidden elements are spelled out, and references found by one search.
_TAG = r"""(?:[^>"']|"[^"]*"|'[^']*')*>"""
_html = "|".join(
    [r"(?is)<!--.*?(?:-->|\z)"]
    + [rf"<{name}\b(?:{_TAG}|[^>]*>).*?(?:</{name}\s*>|\z)" for name in ("script", "style", "template")]
    + [r"<[!?][^>]*>", rf"</?[a-z](?:{_TAG}|[^>]*>)"]
)
_html = replace("replace(html, chr(1), '')", _html, "chr(1)")
_NAMES = f"MAP {{{', '.join(f'{lit(name)}: {lit(shown)}' for name, shown in html5.items())}}}"
_BARE = "|".join(sorted((name for name in html5 if name[-1] != ";"), key=len, reverse=True))
_REFERENCE = rf"&(?:#[0-9]+;|#[xX][0-9a-fA-F]+;|[a-zA-Z][a-zA-Z0-9]*;|{_BARE})"


def _shown(reference: str) -> str:
    """What a reference stands for; one that ends in a semicolon may be a bare name and more."""
    bare = f"regexp_extract({reference}, '^&({_BARE})', 1)"
    digits = f"ltrim(regexp_extract({reference}, '^&#([0-9]+);', 1), '0')"
    sixteen = f"ltrim(regexp_extract({reference}, '^&#[xX]([0-9a-fA-F]+);', 1), '0')"
    number = (
        f"CASE WHEN length({digits}) BETWEEN 1 AND 7 THEN {digits}::BIGINT "
        f"WHEN length({sixteen}) BETWEEN 1 AND 6 THEN ('0x' || {sixteen})::BIGINT END"
    )
    valid = f"({number}) < 1114112 AND ({number}) NOT BETWEEN 55296 AND 57343"
    return (
        f"CASE WHEN {reference}[2] = '#' THEN CASE WHEN {valid} THEN chr(({number})::INTEGER) ELSE {reference} END "
        f"ELSE coalesce(map_extract(names, {reference}[2:])[1], "
        f"map_extract(names, {bare})[1] || {reference}[length({bare}) + 2:], {reference}) END"
    )


# The strings between references alternate with them.
_BETWEEN = f"regexp_split_to_array(s, {lit(_REFERENCE)})"
_FOUND = f"regexp_extract_all(s, {lit(_REFERENCE)})"
_DECODED = (
    f"CASE WHEN contains(s, '&') THEN array_to_string(list_transform(list_zip({_BETWEEN}, {_FOUND}), "
    f"lambda z: z[1] || CASE WHEN z[2] IS NULL THEN '' ELSE {_shown('z[2]')} END), '') ELSE s END"
)
PAGE_TEXT = (
    f"array_to_string(list_filter(list_transform(string_split({_html}, chr(1)), "
    f"lambda s: {strip(_DECODED)}), lambda s: s <> ''), chr(10))"
)

# Analysed words: distinct content terms, and the form each is shown in

ANALYSED = f"""
    t AS (SELECT DISTINCT doc_id, lower(w) AS term
          FROM (SELECT doc_id, unnest({ALNUM}) AS w FROM documents) WHERE length(lower(w)) >= 2),
    f AS (SELECT doc_id, lower(form) AS term, arg_min(form, pos) AS form
          FROM (SELECT doc_id, unnest(ws) AS form, generate_subscripts(ws, 1) AS pos
                FROM (SELECT doc_id, {PIECES} AS ws FROM documents))
          WHERE lower(form) <> form GROUP BY ALL),
    analysed AS (SELECT t.doc_id, t.term, coalesce(f.form, t.term) AS shown
                 FROM t LEFT JOIN f ON t.doc_id = f.doc_id AND t.term = f.term)"""

# Search

SCORES = f"""
    {postings(TERMS)},
    w AS (SELECT doc_id, term, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w
          FROM p JOIN s USING (term), n),
    norm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id),
    qt AS (SELECT qid, term, count(*) AS tf
           FROM (SELECT qid, unnest({TERMS}) AS term FROM q) GROUP BY ALL),
    qw AS (SELECT qid, term, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w
           FROM qt JOIN s USING (term), n),
    qnorm AS (SELECT qid, sqrt(sum(w * w)) AS norm FROM qw GROUP BY qid),
    dot AS (SELECT qid, doc_id, sum(w.w * qw.w) AS dot
            FROM w JOIN qw USING (term) GROUP BY qid, doc_id),
    scores AS (SELECT qid, doc_id, round(dot / (norm.norm * qnorm.norm), 9) AS probability
               FROM dot JOIN norm USING (doc_id) JOIN qnorm USING (qid)
               WHERE round(dot / (norm.norm * qnorm.norm), 9) > 0)"""
ONE_QUERY = f"q AS (SELECT 0 AS qid, {lit(catalog.QUERY)} AS text)"

# Boolean queries

_by_clause: dict[tuple[int, int], list[str]] = {}
for _qid, _clause, _term, _negated in catalog.CLAUSES:
    _by_clause.setdefault((_qid, _clause), []).append(
        ("NOT " if _negated else "") + f"list_contains(terms, {lit(_term)})"
    )
RETRIEVED = "\n    UNION\n".join(
    f"    SELECT {_qid}::BIGINT AS qid, doc_id FROM d WHERE {' AND '.join(_literals)}"
    for (_qid, _), _literals in _by_clause.items()
)
MATCHES = f"""
    d AS (SELECT doc_id, lang, {TERMS} AS terms FROM documents),
    retrieved AS ({RETRIEVED})"""
_languages = ", ".join(f"({qid}::BIGINT, {lit(lang)})" for qid, lang in catalog.QUERY_LANGUAGES)
CONFUSION = f"""
    {MATCHES},
    ql(qid, lang) AS (VALUES {_languages}),
    counts AS (
        SELECT ql.qid,
               count(*) FILTER (r.doc_id IS NOT NULL AND d.lang = ql.lang) AS a,
               count(*) FILTER (r.doc_id IS NOT NULL AND d.lang <> ql.lang) AS b,
               count(*) FILTER (r.doc_id IS NULL AND d.lang = ql.lang) AS c,
               count(*) FILTER (r.doc_id IS NULL AND d.lang <> ql.lang) AS d
        FROM ql CROSS JOIN d LEFT JOIN retrieved r ON r.qid = ql.qid AND r.doc_id = d.doc_id
        GROUP BY ql.qid)"""


def metrics(counts: str) -> str:
    """CTEs m: the five metrics of each row of ``counts``."""
    return f"""
    pr AS (SELECT *, CASE WHEN a + c > 0 THEN a / (a + c)::DOUBLE ELSE 0 END AS recall,
                  CASE WHEN a + b > 0 THEN a / (a + b)::DOUBLE ELSE 0 END AS precision
           FROM {counts}),
    m AS (SELECT *,
                 CASE WHEN a + b + c + d > 0 THEN (a + d) / (a + b + c + d)::DOUBLE ELSE 0 END
                     AS accuracy,
                 CASE WHEN a + b + c + d > 0 THEN (b + c) / (a + b + c + d)::DOUBLE ELSE 0 END
                     AS error,
                 CASE WHEN precision + recall > 0
                      THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f_measure
          FROM pr)"""


METRIC_NAMES = ("recall", "precision", "accuracy", "error", "f_measure")
ROUNDED_METRICS = ", ".join(f"round({name}, 6) + 0.0 AS {name}" for name in METRIC_NAMES)
AVERAGED_METRICS = ", ".join(f"round(avg({name}), 6) + 0.0 AS {name}" for name in METRIC_NAMES)

# Languages

PROFILES = f"""
    profiles AS (SELECT lang, word, count(*) AS pc
                 FROM (SELECT lang, unnest({LETTERS}) AS word FROM documents) GROUP BY ALL),
    langs AS (SELECT DISTINCT lang FROM profiles),
    texts AS (SELECT doc_id, word, count(*) AS tc
              FROM (SELECT doc_id, unnest({LETTERS}) AS word FROM documents) GROUP BY ALL)"""


def overlap(name: str, condition: str) -> str:
    """CTE ``name``: the language of the largest overlap of each document."""
    return f"""
    {name} AS (
        SELECT doc_id, lang FROM (
            SELECT documents.doc_id, langs.lang, row_number() OVER (
                PARTITION BY documents.doc_id ORDER BY coalesce(score, 0) DESC, langs.lang) AS r
            FROM documents CROSS JOIN langs LEFT JOIN (
                SELECT doc_id, profiles.lang, sum(least(tc, pc)) AS score
                FROM texts JOIN profiles USING (word) WHERE {condition}
                GROUP BY doc_id, profiles.lang) o
            ON o.doc_id = documents.doc_id AND o.lang = langs.lang) WHERE r = 1)"""


_spaced_text = f"' ' || {replace('lower(text)', f'[{tx.SPACE}]+', lit(' '))} || ' '"
_triples = " || ".join(find(f"substring(t, {k})", "(?s)...") for k in (1, 2, 3))
CHAR_MODEL = f"""
    g AS MATERIALIZED (SELECT doc_id, lang, unnest({_triples}) AS gram
          FROM (SELECT doc_id, lang, {_spaced_text} AS t FROM documents)),
    model AS (SELECT lang, gram, count(*) AS c FROM g GROUP BY ALL),
    totals AS (SELECT lang, sum(c) AS total FROM model GROUP BY lang),
    vocabulary AS (SELECT count(DISTINCT gram) AS v FROM model),
    k AS (SELECT doc_id, gram, count(*) AS k FROM g GROUP BY ALL),
    known AS (SELECT doc_id, sum(k) AS known
              FROM k SEMI JOIN model ON k.gram = model.gram GROUP BY doc_id),
    hits AS (SELECT doc_id, model.lang, sum(k * ln(c + 1)) AS hits
             FROM k JOIN model ON k.gram = model.gram GROUP BY doc_id, model.lang),
    model_best AS (
        SELECT doc_id, lang FROM (
            SELECT d.doc_id, totals.lang, row_number() OVER (
                PARTITION BY d.doc_id
                ORDER BY round(coalesce(hits, 0) - coalesce(known, 0) * ln(total + v), 6) DESC,
                         totals.lang) AS r
            FROM documents d CROSS JOIN totals CROSS JOIN vocabulary
            LEFT JOIN known ON known.doc_id = d.doc_id
            LEFT JOIN hits ON hits.doc_id = d.doc_id AND hits.lang = totals.lang)
        WHERE r = 1)"""

REPORT = f"""
    {PROFILES},
    {overlap("frequent", "true")},
    {overlap("short", f"length(word) <= {SHORT_WORD}")},
    {CHAR_MODEL},
    report AS (SELECT doc_id, frequent.lang AS freq_result, short.lang AS short_result,
                      model_best.lang AS model_result
               FROM frequent JOIN short USING (doc_id) JOIN model_best USING (doc_id))"""

# Summaries

SENTENCE_ROWS = f"""
    sentences AS MATERIALIZED (
        SELECT doc_id, len(ss) AS s, unnest(ss) AS sentence,
               (generate_subscripts(ss, 1) - 1)::INTEGER AS i
        FROM (SELECT doc_id, {SENTENCES} AS ss FROM documents)),
    cleaned AS MATERIALIZED (
        SELECT doc_id, s, i, {keep(LETTERS.replace("text", "sentence"),
                                   f"NOT ({among('x', SUMMARY_STOP_WORDS)})")} AS ws
        FROM sentences)"""
BIGRAMS = (
    "list_transform(range(1, len(ws)), lambda x: ws[x] || ' ' || ws[x + 1])"
)


def sentence_tf(units: str) -> str:
    """CTEs tf (doc_id, s, i, word, tf, place) and idf (doc_id, word, idf)."""
    return f"""
    {SENTENCE_ROWS},
    units AS (SELECT doc_id, s, i, len(us) AS total, unnest(us) AS word,
                     generate_subscripts(us, 1) AS pos
              FROM (SELECT doc_id, s, i, {units} AS us FROM cleaned)),
    tf AS (SELECT doc_id, s, i, word, count(*) / total::DOUBLE AS tf, min(pos) AS place
           FROM units GROUP BY doc_id, s, i, total, word),
    idf AS (SELECT doc_id, word, ln(s / (1 + count(*))::DOUBLE) AS idf
            FROM tf GROUP BY doc_id, s, word)"""


SENTENCE_WEIGHTS = f"""
    {sentence_tf("ws")},
    raw AS (SELECT doc_id, i, unnest({WORDS.replace("text", "sentence")}) AS word FROM sentences),
    part AS (SELECT doc_id, i, sum(tf * idf) AS part
             FROM raw JOIN tf USING (doc_id, i, word) JOIN idf USING (doc_id, word)
             GROUP BY doc_id, i),
    weighted AS (
        SELECT doc_id, i, sentence, round(coalesce(part, 0)
                   * (1 - abs(i - s / 2::DOUBLE) / (s / 2::DOUBLE))
                   * (1 / (1 + i % 5)::DOUBLE), {WEIGHT_DIGITS}) + 0.0 AS weight
        FROM sentences LEFT JOIN part USING (doc_id, i)),
    picked AS (
        SELECT doc_id, i, sentence FROM (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, i) AS r
            FROM weighted) WHERE r <= {SUMMARY_SENTENCES})"""


KEYWORD_ROWS = f"""
    keyword_rows AS (
        SELECT doc_id, word, weight, r::INTEGER AS rank FROM (
            SELECT *, row_number() OVER (
                PARTITION BY doc_id ORDER BY weight DESC, i, place) AS r
            FROM (SELECT doc_id, word, round(sum(tf * idf), {WEIGHT_DIGITS}) + 0.0 AS weight,
                         min(i) AS i, arg_min(place, i) AS place
                  FROM tf JOIN idf USING (doc_id, word) GROUP BY doc_id, word))
        WHERE r <= {KEYWORDS})"""
KEYWORD_QUERY = "SELECT doc_id, rank, word, weight FROM keyword_rows"

ANALYSIS = f"""
    {SENTENCE_WEIGHTS},
    {KEYWORD_ROWS},
    summaries AS (SELECT doc_id, list(sentence ORDER BY i) AS summary FROM picked GROUP BY doc_id),
    listed AS (SELECT doc_id, string_agg(
                   word || ' --- ' || printf('%.{WEIGHT_DIGITS}f', weight) || chr(10), '' ORDER BY rank)
                   AS keywords FROM keyword_rows GROUP BY doc_id),
    analysis AS (SELECT documents.doc_id, coalesce(summary, []) AS summary,
                        coalesce(keywords, '') AS keywords
                 FROM documents LEFT JOIN summaries USING (doc_id) LEFT JOIN listed USING (doc_id))"""

_path = "'/documents/' || doc_id || '.txt'"
LANGUAGE_BLOCK = " || chr(10) || ".join(
    (
        f"{lit(reports.FILE_LABEL)} || {_path}",
        f"{lit(reports.FREQUENT_LABEL)} || freq_result",
        f"{lit(reports.SHORT_LABEL)} || short_result",
        f"{lit(reports.MODEL_LABEL)} || model_result",
        f"{lit(reports.LINK_LABEL)} || {_path}",
        "''",
    )
)
SUMMARY_BLOCK = (
    f"{lit(reports.FILE_LABEL)} || {_path} || chr(10) || chr(10) || "
    f"{lit(reports.SUMMARY_LABEL)} || chr(10) || "
    "array_to_string(list_transform(summary, lambda x: '- ' || x || chr(10)), '') || "
    f"chr(10) || {lit(reports.KEYWORDS_LABEL)} || chr(10) || keywords"
)


ORACLES = {
    "corpus_scan": "SELECT doc_id, text FROM documents",
    "document_listing": f"""
        SELECT doc_id, {line('text', 1)} AS url, {line('text', 2)} AS title FROM documents""",
    "corpus_profile": """
        SELECT count(*) AS n_docs, sum(strlen(text))::BIGINT AS n_bytes FROM documents""",
    "page_text": f"SELECT page_id, {PAGE_TEXT} AS text FROM pages, (SELECT {_NAMES} AS names)",
    "page_documents": f"""
        SELECT page_id AS doc_id, url || chr(10) || {PAGE_TEXT} AS text FROM pages, (SELECT {_NAMES} AS names)""",
    "language_report_sink": f"""
        WITH {REPORT}
        SELECT unnest(string_split({LANGUAGE_BLOCK}, chr(10))) AS line FROM report""",
    "summary_report_sink": f"""
        WITH {ANALYSIS}
        SELECT unnest(string_split({SUMMARY_BLOCK}, chr(10))) AS line FROM analysis""",
    "stream_ingest": f"""
        SELECT term, count(DISTINCT doc_id) AS df FROM ({tokens(TERMS)}) GROUP BY term""",
    "normalize_letters": words_of(LETTERS),
    "tokenize_words": words_of(WORDS),
    "tokenize_terms": words_of(TERMS),
    "tokenize_alnum": words_of(ALNUM),
    "remove_stop_words": words_of(SIGNIFICANT),
    "split_sentences": f"""
        SELECT doc_id, unnest(ss) AS sentence, (generate_subscripts(ss, 1) - 1)::INTEGER AS i
        FROM (SELECT doc_id, {SENTENCES} AS ss FROM documents)""",
    "abbreviations": f"WITH {ABBREVIATIONS} SELECT word, dotted, plain, score FROM known",
    "split_sentences_trained": f"WITH {TRAINED} SELECT doc_id, i, sentence FROM trained WHERE sentence <> ''",
    "ngrams": f"""
        SELECT doc_id, coalesce(array_to_string({BIGRAMS}, '|'), '') AS words
        FROM (SELECT doc_id, {SIGNIFICANT} AS ws FROM documents)""",
    "restore_case": f"WITH {ANALYSED} SELECT doc_id, term, shown FROM analysed",
    "term_frequency": f"WITH {postings(CONTENT)} SELECT doc_id, term, tf FROM p",
    "doc_frequency": f"WITH {postings(TERMS)} SELECT term, df FROM s",
    "inverted_index": f"""
        WITH {ANALYSED}
        SELECT shown AS term, doc_id // {IDS_PER_BLOCK} AS block,
               string_agg(doc_id, ' ' ORDER BY doc_id) AS doc_ids
        FROM (SELECT DISTINCT doc_id, shown FROM analysed) GROUP BY ALL""",
    "segmented_index": f"""
        WITH living AS (SELECT * FROM documents WHERE doc_id % 7 <> 0 OR doc_id % 5 = 0),
        {postings(TERMS).replace("FROM documents", "FROM living")}
        SELECT term, df, n AS n_docs FROM s, n""",
    "term_lookup": f"""
        WITH {ANALYSED},
        probes AS (SELECT doc_id, unnest([{', '.join(map(lit, catalog.PROBE_WORDS))}]) AS word
                   FROM documents)
        SELECT doc_id, word, (EXISTS (SELECT 1 FROM analysed a
               WHERE a.doc_id = probes.doc_id AND a.shown = probes.word))::INTEGER AS found
        FROM probes""",
    "tfidf_log10": f"""
        WITH {postings(CONTENT)}
        SELECT doc_id, term, round(tf * log10(n / df::DOUBLE), 6) + 0.0 AS w
        FROM p JOIN s USING (term), n""",
    "tfidf_arrival": f"""
        WITH {postings(CONTENT)},
        o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS arrived FROM documents),
        r AS (SELECT doc_id, term, tf,
                     row_number() OVER (PARTITION BY term ORDER BY doc_id) AS df FROM p)
        SELECT doc_id, term, round(tf * log10(arrived / df::DOUBLE), 6) + 0.0 AS w
        FROM r JOIN o USING (doc_id)""",
    "tfidf_log10_smooth": f"""
        WITH {postings(WORDS)},
        given AS (SELECT unnest([{', '.join(map(lit, catalog.GIVEN_TERMS))}]) AS term)
        SELECT documents.doc_id, given.term,
               round(coalesce(tf, 0) * log10(n / (1 + coalesce(df, 0))::DOUBLE), 6) + 0.0 AS w
        FROM documents CROSS JOIN given CROSS JOIN n
        LEFT JOIN p ON p.doc_id = documents.doc_id AND p.term = given.term
        LEFT JOIN s ON s.term = given.term""",
    "tfidf_l2": f"""
        WITH {postings(TERMS)},
        raw AS (SELECT doc_id, term, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w
                FROM p JOIN s USING (term), n),
        norm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY doc_id)
        SELECT doc_id, term, round(w / norm, 6) + 0.0 AS w FROM raw JOIN norm USING (doc_id)""",
    "document_terms": f"""
        WITH c AS (SELECT doc_id, lower(w) AS term, count(*) AS tf
                   FROM (SELECT doc_id, unnest({ALNUM}) AS w FROM documents)
                   WHERE length(lower(w)) >= 2 GROUP BY ALL),
        l AS (SELECT doc_id, sqrt(sum(tf * tf)) AS norm FROM c GROUP BY doc_id),
        {ANALYSED}
        SELECT doc_id, term, shown, round(tf / norm, 6) + 0.0 AS w,
               (row_number() OVER (PARTITION BY doc_id ORDER BY tf DESC, term))::INTEGER AS rank
        FROM c JOIN l USING (doc_id) JOIN analysed USING (doc_id, term)""",
    "tfidf_sentence": f"""
        WITH {sentence_tf("ws")}
        SELECT doc_id, i, word, round(tf, 6) + 0.0 AS tf, round(idf, 6) + 0.0 AS idf
        FROM tf JOIN idf USING (doc_id, word)""",
    "tfidf_ngram": f"""
        WITH {sentence_tf(BIGRAMS)}
        SELECT doc_id, i, word, round(tf, 6) + 0.0 AS tf, round(idf, 6) + 0.0 AS idf
        FROM tf JOIN idf USING (doc_id, word)""",
    "ranked_search": f"""
        WITH {ONE_QUERY}, {SCORES}
        SELECT doc_id, probability FROM scores""",
    "search_top_k": f"""
        WITH q AS (SELECT item_id AS qid, text FROM benchmark), {SCORES}
        SELECT qid, rank::INTEGER AS rank, doc_id, probability
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY qid ORDER BY probability DESC, doc_id) AS rank FROM scores)
        WHERE rank <= {catalog.TOP_K}""",
    "search_results": f"""
        WITH {ONE_QUERY}, {SCORES}
        SELECT doc_id, {line('text', 2)} AS title,
               round(probability::DECIMAL(18, 9), 4)::DOUBLE AS probability
        FROM scores JOIN documents USING (doc_id)""",
    "boolean_search": f"""
        SELECT doc_id, ((list_contains(t, 'the') AND list_contains(t, 'and')
                AND NOT list_contains(t, 'pour')) OR list_contains(t, 'der'))::INTEGER AS rsv
        FROM (SELECT doc_id, {TERMS} AS t FROM documents)""",
    "boolean_search_batch": f"WITH {MATCHES} SELECT qid, doc_id FROM retrieved",
    "confusion_counts": f"WITH {CONFUSION} SELECT qid, a, b, c, d FROM counts",
    "query_metrics": f"""
        WITH {CONFUSION}, {metrics("counts")} SELECT qid, {ROUNDED_METRICS} FROM m""",
    "macro_average": f"""
        WITH {CONFUSION}, {metrics("counts")} SELECT {AVERAGED_METRICS} FROM m""",
    "micro_average": f"""
        WITH {CONFUSION},
        means AS (SELECT avg(a) AS a, avg(b) AS b, avg(c) AS c, avg(d) AS d FROM counts),
        {metrics("means")} SELECT {ROUNDED_METRICS} FROM m""",
    "language_profiles": f"WITH {PROFILES} SELECT lang, word, pc FROM profiles",
    "language_frequent_words": f"""
        WITH {PROFILES}, {overlap("best", "true")} SELECT doc_id, lang FROM best""",
    "language_short_words": f"""
        WITH {PROFILES}, {overlap("best", f"length(word) <= {SHORT_WORD}")}
        SELECT doc_id, lang FROM best""",
    "language_char_model": f"WITH {CHAR_MODEL} SELECT doc_id, lang FROM model_best",
    "language_report": f"""
        WITH {REPORT} SELECT doc_id, freq_result, short_result, model_result FROM report""",
    "sentence_weights": f"""
        WITH {SENTENCE_WEIGHTS} SELECT doc_id, i, weight FROM weighted""",
    "summary": f"WITH {SENTENCE_WEIGHTS} SELECT doc_id, i, sentence FROM picked",
    "keywords": f"""
        WITH {sentence_tf("ws")}, {KEYWORD_ROWS} {KEYWORD_QUERY}""",
    "keyphrases": f"""
        WITH {sentence_tf(BIGRAMS)}, {KEYWORD_ROWS} {KEYWORD_QUERY}""",
    "document_analysis": f"""
        WITH {ANALYSIS}
        SELECT doc_id, coalesce(array_to_string(summary, chr(10)), '') AS summary, keywords
        FROM analysis""",
}
# The same rows by other ways.
ORACLES["search_blocks"] = ORACLES["search_top_k"]
ORACLES["tfidf_arrival_stream"] = ORACLES["tfidf_arrival"]
