"""Ranks, group means and top rows per group, safe for heavy groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import descending, exact_mean, fixed_point
from riskloom.operators.joins import null_safe
from riskloom.operators.ordering import (
    HOT_ROWS, SLICE_ROWS, HotKeys, Running, hot_keys, order_slices, sliced_running, split_hot)

KINDS = ("row_number", "rank", "dense_rank")


def rank_within(df: DataFrame, by: Sequence[str], value: str, row_id: str, kind: str, name: str,
                hot_rows: int = HOT_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Rank rows of each group by descending value, NULL first (ties by id for row_number)."""
    if kind not in KINDS:
        raise ValueError(f"unknown rank: {kind}")
    hot = hot_keys(df, by, hot_rows)
    if hot is None:
        return _plain_rank(df, by, value, row_id, kind, name)
    cold, heavy = split_hot(df, by, hot)
    return _plain_rank(cold, by, value, row_id, kind, name).unionByName(
        _sliced_rank(heavy, by, value, row_id, kind, name, hot, slice_rows))


def _plain_rank(df, by, value, row_id, kind, name) -> DataFrame:
    order = [descending(value), F.asc(row_id)] if kind == "row_number" else [descending(value)]
    return df.withColumn(name, getattr(F, kind)().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint"))


def _sliced_rank(df, by, value, row_id, kind, name, hot: HotKeys, slice_rows: int) -> DataFrame:
    one = F.lit(1).cast("bigint")
    if kind == "row_number":
        order = [descending(value), F.asc(row_id)]
        cut = order_slices(df, [*by, *order], hot.rows, slice_rows=slice_rows)
        return sliced_running(cut, by, "_slice", order, [Running(name, "sum", one)]).drop("_slice")
    # Rows with equal values share their rank, so one row per value is enough.
    values = df.groupBy(*by, value).agg(F.count(one).alias("_n"))
    cut = order_slices(values, [*by, descending(value)], hot.rows, slice_rows=slice_rows)
    step = F.col("_n") if kind == "rank" else one
    ranked = sliced_running(cut, by, "_slice", [descending(value)], [Running("_before", "sum", step, False)])
    ranked = ranked.select(*[F.col(c).alias(f"_r_{c}") for c in (*by, value)],
                           (F.coalesce("_before", F.lit(0)) + 1).cast("bigint").alias(name))
    joined = df.join(ranked, null_safe(df, ranked, {c: f"_r_{c}" for c in (*by, value)}))
    return joined.select(*[df[c] for c in df.columns], name)


def top_within(df: DataFrame, by: Sequence[str], value: str, row_id: str, n: int, name: str = "rn") -> DataFrame:
    """First ``n`` rows per group. Spark limits each group before the shuffle, so heavy groups stay small."""
    return _plain_rank(df, by, value, row_id, "row_number", name).where(F.col(name) <= n)


def group_mean_per_row(df: DataFrame, by: Sequence[str], value: str, name: str, scale: int = 2) -> DataFrame:
    """Mean of the group on every row: aggregate first, join back."""
    units = fixed_point(F.col(value), scale)
    means = df.groupBy(*by).agg(exact_mean(F.sum(units), F.count(units), scale).alias(name))
    means = means.withColumnsRenamed({c: f"_g_{c}" for c in by})
    return df.join(means, null_safe(df, means, {c: f"_g_{c}" for c in by})).select(*[df[c] for c in df.columns], name)
