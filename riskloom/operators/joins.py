"""Joins between transactions, side tables, derived tables and scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe(left: DataFrame, right: DataFrame, names: dict[str, str]) -> Column:
    """Equi-join condition in which NULL equals NULL; ``names`` maps left to right columns."""
    return reduce(Column.__and__, [left[a].eqNullSafe(right[b]) for a, b in names.items()])


def join_identity(transactions: DataFrame, identity: DataFrame, on: str = "TransactionID") -> DataFrame:
    """Sparse side table by left join. No hint: AQE broadcasts only what measures small."""
    return transactions.join(identity, on, "left")


def assemble(features: DataFrame, raw: DataFrame, on: str = "TransactionID", check: bool = True) -> DataFrame:
    """Add to ``features`` the columns only ``raw`` has; ``on`` must be unique in ``raw``."""
    if check:
        repeated = raw.groupBy(on).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if not repeated.isEmpty():
            raise ValueError(f"{on} repeats in the raw table")
    extra = [c for c in raw.columns if c not in features.columns]
    return features.join(raw.select(on, *extra), on, "left")


def update_from(target: DataFrame, source: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """Take ``columns`` from the matching source row, also when its value is NULL; keep them without a match."""
    changes = source.select(F.col(on).alias("_on"), F.lit(True).alias("_hit"),
                            *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.join(changes, target[on] == changes["_on"], "left")
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(target[c]).alias(c) if c in columns else target[c]
        for c in target.columns])


def exists_earlier(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, flag: str) -> DataFrame:
    """1 when ``right`` has a row with equal (NULL-safe) keys and a strictly earlier time, else 0.

    Some earlier row exists exactly when the earliest one is earlier, so the
    right side shrinks to one row per key before the join and no group is
    compared pair by pair.
    """
    earliest = right.groupBy(*keys).agg(F.min(time).alias("_earliest"))
    earliest = earliest.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    joined = left.join(earliest, null_safe(left, earliest, {k: f"_r_{k}" for k in keys}), "left")
    earlier = F.coalesce(F.col("_earliest") < left[time], F.lit(False))
    return joined.select(*[left[c] for c in left.columns], earlier.cast("bigint").alias(flag))


def attach_scores(df: DataFrame, scores: DataFrame, on: str = "TransactionID") -> DataFrame:
    """Score column by key, never by position."""
    return df.join(scores, on, "left")
