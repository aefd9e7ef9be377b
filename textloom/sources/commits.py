"""Collections that grow by whole runs, each of them once.

A run writes its part into a folder of its own and then one small file, its entry in the manifest.
Readers follow the manifest, so a part that was written without getting there is not seen, and
a run whose entry is there already writes nothing: it can be repeated after any failure. Nothing
is deleted; parts without an entry may go whenever no run is under way. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

ENTRY = "run string, folder string"


def published(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder of each run in the manifest of the collection at ``path``."""
    try:
        entries = spark.read.schema(ENTRY).parquet(f"{path}/manifest").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {entry["run"]: f"{path}/{entry['folder']}" for entry in entries}


def publish(spark: SparkSession, path: str, run: str, write: Callable[[str], None]) -> bool:
    """Add what ``write(folder)`` writes as the part of ``run``; False if that run was there already."""
    if run in published(spark, path):
        return False
    folder = f"parts/{uuid.uuid4().hex}"
    write(f"{path}/{folder}")
    spark.createDataFrame([(run, folder)], ENTRY).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return True
