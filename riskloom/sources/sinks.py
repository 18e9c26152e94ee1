"""Batch sinks: split Parquet, submissions, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One Parquet folder per split; a reader of one split opens no other."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def read_split(spark: SparkSession, path: str, value: str, split: str = "split") -> DataFrame:
    return spark.read.parquet(path).where(F.col(split) == value).drop(split)


def write_submission(df: DataFrame, path: str, row_id: str = "TransactionID", decision: str = "isFraud") -> None:
    """(id, class) as CSV with a header, one file per task."""
    df.select(row_id, F.col(decision).cast("int").alias(decision)).write.mode("overwrite").option("header", True).csv(path)


def save_bucketed(df: DataFrame, name: str, path: str, on: str, buckets: int) -> DataFrame:
    """Store rows as a table dealt and sorted by ``on``, one file per bucket, and return the table.

    Tables with equal bucket counts meet on ``on`` without a shuffle, and so do
    their groups; choose the count for the larger table, a bucket being one
    task's share. Rows with a NULL in ``on`` are one bucket's. An existing table
    of the name is an error, never replaced.
    """
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    dealt = df.repartition(buckets, F.col(on))
    dealt.write.bucketBy(buckets, on).sortBy(on).format("parquet").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def save_as(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Store a query's rows as a Parquet table and return the table."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)
