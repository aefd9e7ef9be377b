"""Every registered query against its SQL twin, on the smallest tables."""

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from textloom.plans.catalog import QUERIES
from textloom.plans.oracle import ORACLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def twins():
    return check.twin_connection(FOLDER)


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_equal(spark, twins, name):
    ours = queries()[name](spark, FOLDER).toPandas()
    twin = twins.execute(oracle_sql()[name]).df()
    assert len(ours) > 0
    assert check.difference(ours, twin) is None


def test_entry(spark):
    best = entry(spark)
    assert best.columns == ["qid", "rank", "doc_id", "probability"]
    assert best.count() == 400


def test_difference_notices():
    frame = duckdb.connect().execute("SELECT 1 AS a, 'x' AS b UNION ALL SELECT 2, 'y'").df()
    assert check.difference(frame, frame[::-1]) is None
    assert check.difference(frame, frame.assign(a=[1, 3])) is not None
    assert check.difference(frame, frame[:1]) is not None
    assert check.difference(frame, frame.rename(columns={"a": "c"})) is not None
