"""Session helpers: a local session for tests and benches, and shared scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A single-machine session, for tests and benches only."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("textloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a folder of its own. On a cluster that is an
    error, as a machine-local folder would be invisible to other machines.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("a shared folder is needed: set spark.checkpoint.dir")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="textloom-")
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, tasks in Python get at most so many rows in a batch, and files are read in batches of as
    many. Both the executor and its worker hold a batch whole, and one of ten thousand texts takes tens of MB in each."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = {name: int(spark.conf.get(name)) for name in names}
    for name, held in before.items():
        if held <= 0 or held > rows:
            spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        for name, held in before.items():
            spark.conf.set(name, str(held))


@contextmanager
def dealt_once(spark: SparkSession) -> Iterator[None]:
    """Within it, tables that are dealt by some of the columns they are joined by stay where they are, and
    what a finished write has shuffled is removed at once instead of when the driver collects its garbage."""
    wanted = {
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    This cuts the lineage of a table with several consumers: it survives the loss
    of executors, is read with column pruning and filter pushdown, and has a cheap
    row count.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of the scratch folder that nothing will read any more: all that was made from it
    has been written itself, so that a lost executor does not ask for it again."""
    if not path.startswith(f"{scratch_dir(spark)}/"):
        raise ValueError(f"not a scratch table: {path}")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
