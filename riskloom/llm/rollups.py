"""Token totals by source, language and tokenizer version, maintained by signed deltas.

A change says what a document counted before and what it counts now: no old
count is an insert, no new one a delete, both a revision. A batch of changes is
summed to one signed row per group and committed under its name; totals are the
sum of what has been committed, so no document is counted again. A batch that
is already committed is skipped, which makes retries and replays harmless: its
folder counts only with the marker that ``commit`` leaves after Spark has written
it, whatever Spark's own markers are set to, and a half-written one is
overwritten. ``compact`` folds the batches of one listing into a snapshot; a batch
committed meanwhile is neither in its totals nor among its names.

Changes are combined before they are shuffled, so a group may hold any share of
the rows. NULL sources or languages are groups of their own. Rows with neither
count change nothing; repeated rows are repeated changes, unless
``distinct_changes`` says that every change is delivered with a number. Groups
whose totals are all zero are left out. No batches, or empty ones, give empty
totals. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = ("source", "lang", "tokenizer_version")


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _children(spark: SparkSession, path: str) -> list[str]:
    if not _exists(spark, path):
        return []
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return sorted(s.getPath().getName() for s in listed)


def _whole(spark: SparkSession, path: str) -> bool:
    return _exists(spark, f"{path}/_COMMITTED")


def _mark(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_COMMITTED")
    where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True).close()


def deltas(changes: DataFrame, group: tuple[str, ...] = GROUP) -> DataFrame:
    """Signed (docs, tokens) per group of (group..., old_tokens, new_tokens) rows."""
    old, new = F.col("old_tokens"), F.col("new_tokens")
    docs = new.isNotNull().cast("bigint") - old.isNotNull().cast("bigint")
    zero = F.lit(0).cast("bigint")
    tokens = F.coalesce(new.cast("bigint"), zero) - F.coalesce(old.cast("bigint"), zero)
    return changes.groupBy(*group).agg(F.sum(docs).alias("docs"), F.sum(tokens).alias("tokens"))


def distinct_changes(changes: DataFrame, number: str = "change_no") -> DataFrame:
    """One row per change number, for sources that may deliver a change twice."""
    return changes.dropDuplicates([number])


def commit(store: str, batch: str, changes: DataFrame, group: tuple[str, ...] = GROUP) -> bool:
    """Commits ``changes`` as ``batch``; False if that batch was committed before."""
    spark, path = changes.sparkSession, f"{store.rstrip('/')}/batches/{batch}"
    if _whole(spark, path):
        return False
    deltas(changes, group).write.mode("overwrite").parquet(path)
    _mark(spark, path)
    return True


def batches(spark: SparkSession, store: str) -> list[str]:
    """Names of the committed batches."""
    folder = f"{store.rstrip('/')}/batches"
    return [b for b in _children(spark, folder) if _whole(spark, f"{folder}/{b}")]


def _snapshot(spark: SparkSession, store: str) -> tuple[str | None, set[str]]:
    """The newest snapshot and the batches in it."""
    folder = f"{store.rstrip('/')}/snapshots"
    for name in reversed(_children(spark, folder)):
        path = f"{folder}/{name}"
        if _whole(spark, f"{path}/names") and _whole(spark, f"{path}/totals"):
            # One row per batch.
            return f"{path}/totals", {r["name"] for r in spark.read.parquet(f"{path}/names").collect()}
    return None, set()


def totals(spark: SparkSession, store: str, group: tuple[str, ...] = GROUP, names: list[str] | None = None) -> DataFrame:
    """(group..., n_docs, n_tokens) over all committed batches, or over those of an earlier listing ``names``."""
    whole, inside = _snapshot(spark, store)
    listed = batches(spark, store) if names is None else names
    parts = [f"{store.rstrip('/')}/batches/{b}" for b in listed if b not in inside]
    parts += [whole] if whole else []
    if not parts:
        schema = ", ".join(f"{g} string" for g in group) + ", n_docs bigint, n_tokens bigint"
        return spark.createDataFrame([], schema)
    summed = spark.read.parquet(*parts).groupBy(*group).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
    return summed.where((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))


def compact(spark: SparkSession, store: str, group: tuple[str, ...] = GROUP) -> None:
    """Writes a snapshot of all committed batches; later totals read it and the batches after it."""
    names = batches(spark, store)
    if not names:
        return
    path = f"{store.rstrip('/')}/snapshots/{len(_children(spark, store.rstrip('/') + '/snapshots')):08d}"
    (totals(spark, store, group, names).withColumnsRenamed({"n_docs": "docs", "n_tokens": "tokens"})
     .write.mode("overwrite").parquet(f"{path}/totals"))
    _mark(spark, f"{path}/totals")
    spark.createDataFrame([(n,) for n in names], "name string").write.mode("overwrite").parquet(f"{path}/names")
    _mark(spark, f"{path}/names")
