"""The Merkle manifest against a brute-force tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import check
from textloom.llm import merkle_manifest as merkle
from textloom.llm.oracle import ORACLES
from textloom.operators import joins

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(leaves):
    """The root, and for each leaf what is left and right of it and its ancestors."""
    nodes, own, proofs = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        for i, at in enumerate(own):
            first = at - at % 3
            proofs[i].append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 3])))
            own[i] = at // 3
        nodes = [digest(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], proofs


def brute(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    inner = []
    for source in sources:
        ordered = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        inner.append((ordered, *tree([leaf(r) for r in ordered])))
    root, above = tree([subroot for _, subroot, _ in inner])
    out = []
    for (ordered, subroot, proofs), rest in zip(inner, above):
        for row, proof in zip(ordered, proofs):
            text = row[4]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf((*row[:4], text))
            for left, right in proof + rest:
                node = digest(left, node, right)
            siblings = digest(*[left + right for left, right in proof + rest])
            out.append((row[0], leaf(row), subroot, root, siblings, node, node == root))
    return sorted(out, key=str)


def found(docs):
    checked = merkle.checked(merkle.manifest(docs, merkle.without_line_feeds()))
    assert checked.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(row) for row in checked.collect()), key=str)


def made(sizes, draw):
    rows = []
    for source, size in sizes.items():
        for _ in range(size):
            text = draw.choice([None, "", "a", "a\nb\n", "é\n文", "line\r\n" * 3])
            rows.append((draw.randrange(10**6), source, draw.choice([None, "en"]), draw.choice([None, 3]), text))
    return rows


def test_trees_of_many_sizes(spark):
    """Sources of 1 to 85 rows, around each power of the fanout."""
    draw = random.Random(1)
    sizes = [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 80, 81, 82, 85]
    rows = made({f"s{i}": n for i, n in enumerate(sizes)}, draw)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_many_sources_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(merkle, "fits_broadcast", lambda table: False)
    monkeypatch.setattr(merkle, "ROWS_PER_PART", 40)
    draw = random.Random(2)
    rows = made({f"s{i}": 1 for i in range(60)} | {"hot": 800}, draw)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_odd_rows(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, "x\n"), (1, None, "en", 1, "x\n"), (7, "", "", 0, ""),
        (7, "", "", 0, "other"), (7, "", "", 0, ""), (-3, "é", "fr", 2, "a\nb"), (2, "z", "en", 5, "a\n" * 200_000),
        (2, "Z", "en", 5, "-"), (3, "\U0001f600", "en", None, "1:x"), (3, "￿", None, 1, "b"),
    ]
    docs = spark.createDataFrame([(*r, 0.5, "x") for r in rows], SCHEMA + ", pos double, g string")
    assert found(docs) == brute(rows)
    assert found(docs.limit(0)) == []
    one = rows[7:8]
    assert found(spark.createDataFrame(one, SCHEMA)) == brute(one)


def test_equal_rows_share_no_range(spark):
    """Most rows equal: each is a leaf of its own."""
    rows = [(5, "a", "en", 1, "same\n")] * 700 + [(i, "a", "en", 1, "t") for i in range(300)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_tampering_is_noticed(spark):
    """Any other text leads elsewhere; the own one leads to the root."""
    rows = [(i, f"s{i % 4}", "en", 1, f"text {i}") for i in range(50)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert merkle.checked(merkle.manifest(docs)).where("verified").count() == 50
    other = merkle.manifest(docs, F.when(F.col("doc_id") == 9, F.lit("text")).otherwise(F.col("text")))
    assert [r["doc_id"] for r in merkle.checked(other).where("NOT verified").collect()] == [9]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_twin_and_brute_force_agree(folder):
    twins = check.twin_connection(folder)
    rows = twins.execute("SELECT doc_id, source, lang, n_chars, text FROM documents").fetchall()
    twin = twins.execute(ORACLES["op13_merkle_manifest"]).fetchall()
    assert sorted((tuple(row) for row in twin), key=str) == brute(rows)
