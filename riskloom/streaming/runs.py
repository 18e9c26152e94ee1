"""Sources, replay protection and bounded runs of streams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import scratch_path


def read_stream(spark: SparkSession, folder: str, pattern: str, schema: T.StructType,
                files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream; the trigger size bounds what one batch may hold."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def drop_replays(stream: DataFrame, time: str, row_id: str, delay: str = "1 hour") -> DataFrame:
    """Each id once, as long as its replay arrives within ``delay``; the watermark lets state expire."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([row_id])


def run_available(stream: DataFrame, name: str) -> DataFrame:
    """Process what is there now, exactly once, into a new table of the shared folder."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    query = (stream.writeStream.format("parquet").option("path", f"{path}/rows")
             .option("checkpointLocation", f"{path}/progress").outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


@dataclass(frozen=True)
class LateSplit:
    """``rows``: each id once, in time; ``late``: rows behind the watermark; ``counts``: one row per batch."""

    rows: DataFrame
    late: DataFrame
    counts: DataFrame


COUNTS = "batch bigint, n_rows bigint, n_replayed bigint, n_late bigint, max_time bigint, watermark bigint"


def run_with_late(stream: DataFrame, name: str, time: str, row_id: str, delay: int, path: str | None = None) -> LateSplit:
    """Process what is there now; rows more than ``delay`` seconds behind the latest row of earlier batches go to a side table.

    ``time`` holds epoch seconds. The watermark of a batch comes from the counts
    that earlier batches committed, so a batch that is run again is split alike,
    and overwrites its own folders. A replay is a row whose id came before, in
    this batch or in one that the watermark still reaches; only stored rows
    above the watermark are read to find them. Rows without a time are late,
    rows without an id are never replays. With the same ``path`` a later call
    goes on where the last one stood.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, name)
    schema = stream.schema

    def counts() -> DataFrame:
        return spark.read.schema(COUNTS).parquet(f"{path}/counts/batch=*")

    def split(rows: DataFrame, batch: int) -> None:
        before = counts().where(F.col("batch") < batch).agg(F.max("max_time")).first()[0] if batch else None
        watermark = None if before is None else before - delay
        rows.persist()
        behind = F.col(time).isNull() if watermark is None else F.coalesce(F.col(time) <= watermark, F.lit(True))
        fresh, late = rows.where(~behind), rows.where(behind)
        first = fresh.where(F.col(row_id).isNotNull()).dropDuplicates([row_id])
        if batch:
            # The partition column of the folders is not read: the rows have the stream's own columns.
            stored = spark.read.schema(schema).parquet(f"{path}/rows/batch=*")
            earlier = [c for c in (F.col(time) > watermark,) if watermark is not None]
            seen = (stored.where(earlier[0]) if earlier else stored).select(F.col(row_id).alias("_seen")).distinct()
            first = first.join(seen, F.col(row_id) == F.col("_seen"), "left_anti")
        kept = first.unionByName(fresh.where(F.col(row_id).isNull()))
        kept.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")
        late.write.mode("overwrite").parquet(f"{path}/late/batch={batch}")
        n, n_late, latest = rows.agg(F.count(F.lit(1)), F.count(F.when(behind, 1)), F.max(time)).first()
        n_kept = spark.read.schema(schema).parquet(f"{path}/rows/batch={batch}").count()
        entry = (batch, n_kept, n - n_late - n_kept, n_late, max((t for t in (latest, before) if t is not None), default=None), watermark)
        spark.createDataFrame([entry], COUNTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/counts/batch={batch}")
        rows.unpersist()

    query = (stream.writeStream.foreachBatch(split).option("checkpointLocation", f"{path}/progress")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return LateSplit(spark.read.schema(schema).parquet(f"{path}/rows/batch=*"),
                     spark.read.schema(schema).parquet(f"{path}/late/batch=*"), counts())
