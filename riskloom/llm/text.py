"""Text helpers shared by the operators: words, ASCII lower case, Arrow batches in small pieces."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows and bytes of text that one step of a Python task holds at a time.
PIECE_ROWS = 2048
PIECE_BYTES = 1 << 20

# bytes.split() without arguments cuts at exactly these six characters.
WHITE = r"\x20\x09-\x0D"
WORD = rf"[^{WHITE}]+"

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(column: Column) -> Column:
    """Lower-cases A-Z only, whatever the locale or script."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def utf8(column: Column) -> Column:
    """The bytes of a text; NULL counts as the empty text."""
    return F.coalesce(column.cast("binary"), F.lit(b""))


# Pieces after which a worker gives freed memory back; workers live on from stage to stage.
RELEASE_PIECES = 64


def release_memory() -> None:
    """Returns memory that is free inside the process to the system, where the C library can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def pieces(batches: Iterator[pa.RecordBatch], column: int | str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded rows and, but for single long texts, bounded bytes of ``column``."""
    given = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if i > start and (i - start >= PIECE_ROWS or held + n > limit):
                yield batch.slice(start, i - start)
                start, held, given = i, 0, given + 1
                if given % RELEASE_PIECES == 0:
                    release_memory()
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
    release_memory()


def total_bytes(df: DataFrame, column: str) -> int:
    """Bytes of all texts; one row reaches the driver."""
    return int(df.agg(F.sum(F.octet_length(F.col(column)).cast("bigint"))).first()[0] or 0)
