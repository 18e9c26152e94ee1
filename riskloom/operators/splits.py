"""Splits by time and stratified folds, without a global sort."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordering import Running, keys_at, sliced_running

# Default shares of the time split.
TRAIN_SIZE = 0.7
TEST_SIZE = 0.15


def split_sizes(n: int, train_size: float = TRAIN_SIZE, test_size: float = TEST_SIZE) -> tuple[int, int]:
    """(first validation position, first test position) of ``n`` rows in time order."""
    if train_size <= 0 or test_size <= 0:
        raise ValueError("train_size and test_size must be positive")
    if train_size + test_size >= 1:
        raise ValueError("train_size and test_size leave no rows for validation")
    if n == 0:
        raise ValueError("no rows to split")
    return int(n * train_size), n - int(n * test_size)


@dataclass(frozen=True)
class TimeCuts:
    """The (time, id) keys where validation and test begin; None when that part is empty."""

    val_from: tuple[int, int] | None
    test_from: tuple[int, int] | None
    time: str = "TransactionDT"
    row_id: str = "TransactionID"

    def _before(self, key: tuple[int, int] | None) -> Column:
        if key is None:
            return F.col(self.time).isNotNull()
        at_time, at_id = key
        return (F.col(self.time) < at_time) | ((F.col(self.time) == at_time) & (F.col(self.row_id) < at_id))

    def predicate(self, split: str) -> Column:
        """Rows of one split, as comparisons with literals: the filter reaches the scan."""
        in_train, before_test = self._before(self.val_from), self._before(self.test_from)
        # Rows without a time come last.
        after = F.col(self.time).isNull() | ~before_test
        return {"train": in_train, "val": ~in_train & before_test, "test": after}[split]

    def label(self) -> Column:
        return F.when(self.predicate("train"), "train").when(self._before(self.test_from), "val").otherwise("test")


def time_cuts(df: DataFrame, train_size: float = TRAIN_SIZE, test_size: float = TEST_SIZE,
              time: str = "TransactionDT", row_id: str = "TransactionID") -> TimeCuts:
    """Cut keys in (time, id) order, exact to the row, found by counting; rows without a time are extra test rows."""
    keys = df.select(time, row_id).where(F.col(time).isNotNull())
    n, low, high = keys.agg(F.count(F.lit(1)), F.min(time), F.max(time)).first()
    positions = split_sizes(n, train_size, test_size)
    inner = sorted({p for p in positions if p < n})
    found = dict(zip(inner, keys_at(keys, [time, row_id], inner, low, high)))
    return TimeCuts(found.get(positions[0]), found.get(positions[1]), time, row_id)


def time_split(df: DataFrame, train_size: float = TRAIN_SIZE, test_size: float = TEST_SIZE,
               time: str = "TransactionDT", row_id: str = "TransactionID") -> DataFrame:
    """Add ``split``: train, val or test."""
    return df.withColumn("split", time_cuts(df, train_size, test_size, time, row_id).label())


def label_rate(df: DataFrame, label: str = "isFraud", by: str = "split") -> DataFrame:
    """Rows and mean label per split: the drift check."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"),
                              (F.sum(label).cast("double") / F.count(label)).alias("label_rate"))


def stratified_folds(df: DataFrame, folds: int = 5, seed: int = 42, label: str = "isFraud",
                     row_id: str = "TransactionID", digits: int = 3) -> DataFrame:
    """Add ``fold`` 0..folds-1, shuffled by a seeded hash of the id.

    Rows are dealt in (label, hash) order, so fold sizes differ by at most one
    row, per label and overall. The order is cut by the first hash digits:
    16**digits even slices per label however rows are distributed.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")))
    keyed = df.withColumn("_hash", digest).withColumn("_slice", F.struct(F.col(label).alias("l"), F.substring("_hash", 1, digits).alias("h")))
    ranked = sliced_running(keyed, [], "_slice", ["_hash", row_id], [Running("_rank", "sum", F.lit(1).cast("bigint"))])
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % folds).cast("int")).drop("_hash", "_slice", "_rank")
