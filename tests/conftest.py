import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from textloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", partitions=4, memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def corpus_of(spark):
    """Make a corpus of the given texts, numbered from 0."""

    def make(*texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")

    return make


def rows(df, *order):
    return [tuple(row) for row in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture(scope="session")
def rows_of():
    return rows


@pytest.fixture(scope="session")
def value_of(spark):
    """Evaluate a text function on one string."""

    def evaluate(function, text):
        df = spark.createDataFrame([(text,)], "text string")
        return df.select(function("text").alias("v")).first()["v"]

    return evaluate
