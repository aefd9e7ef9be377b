"""DuckDB twins of the queries in this subpackage that SQL can express."""

from __future__ import annotations

from textloom.llm.license_scan import SIMILARITY, TEMPLATES, WORDS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_NOTICES = ", ".join(f"({_text(name)}, {_text(notice)})" for name, notice in TEMPLATES.items())
_RUN = " || ' ' || ".join(f"words[i + {k}]" for k in range(WORDS))

def _leaf(text: str) -> str:
    fields = [f"CAST({name} AS VARCHAR)" for name in ("doc_id", "source", "lang", "n_chars")] + [text]
    parts = [f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in fields]
    return f"sha256({' || '.join(parts)})"


# The checksum's polynomial, one bit at a time, over the digits of an id.
_CRC32 = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT for c in string_split(CAST(doc_id AS VARCHAR), '')]),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), [0::BIGINT for i in range(8)]),
        lambda bits, i: xor(bits >> 1, 3988292384 * (bits & 1)))
), 4294967295)"""


def _tree(name: str, leaves: str) -> str:
    """All nodes above ``leaves(g, n, pos, h)``, with what stands left and right of each in its run."""
    return f"""
        {name} AS (
            SELECT 0 AS level, g, n, pos, h FROM {leaves}
            UNION ALL
            SELECT level + 1, g, (n + 2) // 3, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
            FROM {name} WHERE n > 1 GROUP BY level, g, n, pos // 3
        ),
        {name}_runs AS (
            SELECT level, g, n, pos, h,
                   coalesce(lag(h, 2) OVER run, '') || coalesce(lag(h, 1) OVER run, '') AS before,
                   coalesce(lead(h, 1) OVER run, '') || coalesce(lead(h, 2) OVER run, '') AS behind
            FROM {name}
            WINDOW run AS (PARTITION BY level, g, pos // 3 ORDER BY pos)
        )"""


def _walk(name: str, tree: str, start: str) -> str:
    """From ``start(id, g, pos, proof, folded)`` up to the last node of each group."""
    return f"""
        {name} AS (
            SELECT id, g, 0 AS level, pos, proof, folded FROM {start}
            UNION ALL
            SELECT w.id, w.g, w.level + 1, w.pos // 3, w.proof || r.before || r.behind, sha256(r.before || w.folded || r.behind)
            FROM {name} w JOIN {tree}_runs r ON r.g = w.g AND r.level = w.level AND r.pos = w.pos AND r.n > 1
        )"""


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _whole(scale: int) -> str:
    return f"list_transform(embedding, lambda x: floor({scale} * x::DOUBLE))"


def _best(rows: str, score: str) -> str:
    """The 20 best rows for every row whose id 20 divides; ``rows`` are ``(vec_id, v)``."""
    return f"""
        WITH used AS ({rows}),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, {score} AS score
            FROM used q JOIN used c ON q.vec_id % 20 = 0 AND q.vec_id != c.vec_id AND len(q.v) = len(c.v)
        )
        SELECT query_id, row_number() OVER best::INT AS rank, vec_id, score
        FROM scored
        WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER best <= 20
    """


ORACLES = {
    "op4_license_scan": f"""
        WITH notices(license, notice) AS (VALUES {_NOTICES}),
        texts AS (
            SELECT NULL::BIGINT AS doc_id, license, notice AS t FROM notices
            UNION ALL
            SELECT DISTINCT doc_id, NULL, coalesce(text, '') FROM documents WHERE doc_id IS NOT NULL
        ),
        cut AS (
            SELECT doc_id, license,
                   list_filter(regexp_split_to_array(lower(t), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w != '') AS words
            FROM texts
        ),
        places AS (
            SELECT doc_id, license, words, unnest(range(1, len(words) - {WORDS} + 2)) AS i FROM cut
        ),
        runs AS (SELECT doc_id, license, i - 1 AS pos, {_RUN} AS run FROM places),
        templates AS (
            SELECT license, count(DISTINCT run) AS n, count(*) AS span FROM runs WHERE license IS NOT NULL GROUP BY license
        ),
        hits AS (
            SELECT DISTINCT r.doc_id, t.license, r.pos, r.run
            FROM runs r JOIN runs t ON r.run = t.run AND t.license IS NOT NULL AND r.license IS NULL
        ),
        stretches AS (
            SELECT a.doc_id, a.license, a.pos, count(DISTINCT b.run) AS matched
            FROM hits a
            JOIN templates t USING (license)
            JOIN hits b ON a.doc_id = b.doc_id AND a.license = b.license AND b.pos >= a.pos AND b.pos < a.pos + t.span
            GROUP BY a.doc_id, a.license, a.pos
        ),
        best AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY matched DESC, pos) AS place FROM stretches
        )
        SELECT doc_id, license, pos::INT AS first_word, matched::INT AS matched, n::INT AS template_shingles,
               matched::DOUBLE / n AS containment
        FROM best JOIN templates USING (license)
        WHERE place = 1 AND matched >= n * {SIMILARITY}
    """,
    "op7_exact_dedup": """
        WITH hashed AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(t) AS text_sha256
        FROM hashed
        WINDOW same AS (PARTITION BY t)
    """,
    "op13_merkle_manifest": f"""
        WITH RECURSIVE changed AS (
            SELECT *, CASE WHEN {_CRC32} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM documents
        ),
        hashed AS (
            SELECT doc_id, coalesce('=' || source, '-') AS g, {_leaf("text")} AS h, {_leaf("other")} AS folded FROM changed
        ),
        leaves AS (
            SELECT *, count(*) OVER (PARTITION BY g) AS n, '' AS proof, row_number() OVER () AS id,
                   row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos
            FROM hashed
        ),
        {_tree("inner_tree", "leaves")},
        {_walk("inner_walk", "inner_tree", "leaves")},
        subroots AS (
            SELECT '' AS g, g AS key, h, level, count(*) OVER () AS n, row_number() OVER (ORDER BY g) - 1 AS pos
            FROM inner_tree WHERE n = 1
        ),
        {_tree("outer_tree", "subroots")},
        halfway AS (
            SELECT w.id, s.g, s.pos, w.proof, w.folded, s.h AS subroot
            FROM inner_walk w JOIN subroots s ON s.key = w.g AND s.level = w.level
        ),
        {_walk("outer_walk", "outer_tree", "halfway")},
        top AS (SELECT level, h AS root FROM outer_tree WHERE n = 1)
        SELECT l.doc_id, l.h AS leaf, f.subroot, t.root, sha256(w.proof) AS proof_sha256, w.folded AS folded_root,
               w.folded = t.root AS verified
        FROM outer_walk w JOIN top t USING (level) JOIN leaves l USING (id) JOIN halfway f USING (id)
    """,
    "op5_top_k_search": _best(
        f"SELECT vec_id, {_whole(64)} AS v FROM embeddings WHERE {_FINITE}", "list_inner_product(q.v, c.v)::BIGINT"
    ),
    "op11_block_join": _best(
        f"SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE {_FINITE} AND len(list_filter(embedding, lambda x: x != 0)) > 0",
        "list_inner_product(q.v, c.v)",
    ),
    "op12_hard_negatives": f"""
        WITH used AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_whole(256)} AS v
            FROM embeddings WHERE label IS NOT NULL AND {_FINITE}
        ),
        scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
            FROM used a JOIN used c ON a.vec_id % 100 = 0 AND a.vec_id != c.vec_id AND len(a.v) = len(c.v)
        ),
        positives AS (
            SELECT * FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER best::INT AS rank, n.vec_id AS negative_id,
               p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
        WHERE 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
        WINDOW best AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
        QUALIFY row_number() OVER best <= 5
    """,
    "op1_ngram_join": """
        WITH RECURSIVE words AS (
          SELECT row_number() OVER () AS r, doc_id,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
          FROM documents),
        shingles AS (
          SELECT DISTINCT r, doc_id, md5(array_to_string(ws[i : i + 4], ' ')) AS s
          FROM (SELECT r, doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM words WHERE len(ws) > 0)),
        sizes AS (SELECT r, doc_id, count(*) AS n FROM shingles GROUP BY ALL),
        shared AS (
          SELECT a.r AS a, b.r AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
        links AS (
          SELECT x.doc_id AS a, y.doc_id AS b FROM shared JOIN sizes x ON x.r = shared.a JOIN sizes y ON y.r = shared.b
          WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
        both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reached AS (SELECT a AS doc_id, b AS other FROM both_ways UNION SELECT doc_id, b FROM reached JOIN both_ways ON a = other)
        SELECT words.doc_id, coalesce(n, 0) AS n_shingles, least(words.doc_id, coalesce((SELECT min(other) FROM reached WHERE reached.doc_id = words.doc_id), words.doc_id)) AS component_id
        FROM words LEFT JOIN sizes USING (r)
    """,
    "op8_suffix_dedup": """
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS raw FROM documents),
        starts AS (
          SELECT r, i, md5(raw[i + 1 : i + 400]) AS k
          FROM (SELECT r, raw, unnest(range(0, octet_length(raw) - 399)) AS i FROM docs)),
        covered AS (SELECT r, i FROM starts WHERE k IN (SELECT k FROM starts GROUP BY k HAVING count(*) > 1)),
        marked AS (SELECT r, i, coalesce(i > 400 + lag(i) OVER (PARTITION BY r ORDER BY i), true) AS new FROM covered),
        numbered AS (SELECT r, i, count(*) FILTER (new) OVER (PARTITION BY r ORDER BY i) AS run FROM marked),
        runs AS (SELECT r, run, min(i) AS low, max(i) + 400 AS stop FROM numbered GROUP BY r, run),
        gone AS (SELECT r, sum(stop - low)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY r),
        pieces AS (
          SELECT r, coalesce(lag(stop) OVER (PARTITION BY r ORDER BY low), 0) AS a, low AS b FROM runs
          UNION ALL SELECT r, max(stop), max(octet_length(raw)) FROM runs JOIN docs USING (r) GROUP BY r
          UNION ALL SELECT r, 0, octet_length(raw) FROM docs WHERE r NOT IN (SELECT r FROM runs)),
        kept AS (SELECT r, string_agg(hex(raw[a + 1 : b]), '' ORDER BY a) AS h FROM pieces JOIN docs USING (r) GROUP BY r)
        SELECT doc_id, octet_length(raw)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(h)) AS kept_sha256
        FROM docs JOIN kept USING (r) LEFT JOIN gone USING (r)
    """,
}
