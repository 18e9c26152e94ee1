"""Run metadata: append-only entries, the latest value of a name wins."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

SCHEMA = "name string, value string, version bigint"
PREFIX, SUFFIX = "version-", ".json"


def meta_table(spark: SparkSession, path: str) -> DataFrame:
    """(name, value, version) with the latest value per name, as JSON text."""
    entries = spark.read.schema(SCHEMA).json(path)
    return entries.groupBy("name").agg(F.max_by("value", "version").alias("value"), F.max("version").alias("version"))


def read_meta(spark: SparkSession, path: str) -> dict[str, Any]:
    """All entries as a dictionary; empty when nothing was written yet."""
    try:
        return {r["name"]: json.loads(r["value"]) for r in meta_table(spark, path).collect()}
    except AnalysisException:
        return {}


def _versions(spark: SparkSession, path: str) -> int:
    """The latest version that a writer has claimed, 0 without any."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in system.listStatus(folder)] if system.exists(folder) else []
    claimed = [int(n[len(PREFIX):-len(SUFFIX)]) for n in names if n.startswith(PREFIX) and n.endswith(SUFFIX)]
    return max(claimed, default=0)


def _claim(spark: SparkSession, path: str, version: int, text: str) -> bool:
    """Creates the version's file; False if another writer has it. Atomic where the store's create is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{PREFIX}{version:012d}{SUFFIX}")
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = system.create(where, False)
    except Exception as e:  # the gateway wraps the store's own error
        if system.exists(where):
            return False
        raise e
    out.write(bytearray(text.encode()))
    out.close()
    return True


def add_meta(spark: SparkSession, path: str, entries: dict[str, Any]) -> int:
    """Append entries as one new version, which is returned. Older ones stay on disk, so a failed write loses nothing.

    A version is a file that must not exist yet: of two writers one gets the
    number and the other tries the next.
    """
    version = _versions(spark, path) + 1
    while True:
        lines = [json.dumps({"name": name, "value": json.dumps(value), "version": version}) for name, value in entries.items()]
        if _claim(spark, path, version, "\n".join(lines) + "\n"):
            return version
        version = max(_versions(spark, path), version) + 1
