"""Session defaults and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime settings every entry point of the library wants. UTC keeps epoch
# arithmetic independent of the host; AQE picks join strategies and splits
# skewed joins from measured sizes.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(app: str = "riskloom", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: there the driver
    and the executors are one process. Elsewhere an unset folder is an error,
    because a machine-local path would be lost with its executor.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for a written table below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from Parquet in the shared folder: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def at_once[T, R](spark: SparkSession, work: Callable[[T], R], items: Sequence[T], n: int) -> list[R]:
    """``work`` of every item, in order, ``n`` of them at a time from threads of the driver."""
    if n <= 1:
        return [work(i) for i in items]
    with ThreadPoolExecutor(n) as pool:
        # Each thread has its own copy of the local properties, where Spark keeps the running query.
        started = [pool.submit(inheritable_thread_target(spark)(work), i) for i in items]
        try:
            return [s.result() for s in started]
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise


def parallelism(spark: SparkSession) -> int:
    """Number of shuffle partitions the session is sized for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
