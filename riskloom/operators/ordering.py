"""Running aggregates over an order that no single task could hold.

``Window.partitionBy(key)`` puts all rows of a key into one task, and a window
without a partition puts the whole table there. Both are avoided in the same
way: cut the order into slices of bounded size, run the window inside each
slice, and add what came before from a small table of slice totals.

``running`` decides per key: keys below ``hot_rows`` take the plain window (one
shuffle, no extra work), heavier keys take the sliced form.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import parallelism, written

# A key with more rows than this is cut into slices.
HOT_ROWS = 1_000_000
# Rows aimed at per slice.
SLICE_ROWS = 1_000_000
# Smaller slices are asked for only up to this number of them: beyond, slices grow
# towards SLICE_ROWS rows first, as every slice costs a task and a file.
MANY_SLICES = 512
# The heaviest keys that are treated as hot. By pigeonhole every other key has
# at most (all rows / MAX_HOT_KEYS) rows, and the list stays a few megabytes.
MAX_HOT_KEYS = 100_000


@dataclass(frozen=True)
class Running:
    """One running aggregate: ``op`` is sum, min, max or last; ``whole`` asks for the key's total instead."""

    name: str
    op: str
    column: Column
    inclusive: bool = True
    whole: bool = False


@dataclass(frozen=True)
class HotKeys:
    keys: DataFrame
    rows: int


def hot_keys(df: DataFrame, by: Sequence[str], hot_rows: int = HOT_ROWS) -> HotKeys | None:
    """Keys holding more than ``hot_rows`` rows, or None when there are none.

    One pass over the key columns with map-side counting; at most MAX_HOT_KEYS
    rows reach the driver.
    """
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    top = counts.orderBy(F.desc("_n"), *by).limit(MAX_HOT_KEYS).collect()
    if not top:
        return None
    keys = df.sparkSession.createDataFrame([tuple(r[c] for c in by) for r in top], df.select(*by).schema)
    return HotKeys(keys, sum(r["_n"] for r in top))


def split_hot(df: DataFrame, by: Sequence[str], hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """(rows of other keys, rows of hot keys); the broadcast list is bounded by MAX_HOT_KEYS."""
    names = {c: f"_hot_{c}" for c in by}
    keys = F.broadcast(hot.keys.withColumnsRenamed(names))
    same = reduce(Column.__and__, [df[c].eqNullSafe(keys[names[c]]) for c in by])
    return df.join(keys, same, "left_anti"), df.join(keys, same, "left_semi")


def order_slices(df: DataFrame, order: Sequence[Column | str], rows: int, name: str = "_slice",
                 slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Number contiguous, evenly sized slices of the ascending ``order``.

    Spark's range partitioner samples the whole composite key, so bursts and
    equal times are cut as well. The numbered rows are written to the shared
    folder: a lost executor must not renumber slices under a half-finished job.
    A slice aims at ``slice_rows`` rows, or at up to SLICE_ROWS where that would
    make more than MANY_SLICES slices.
    """
    pieces = slice_count(rows, slice_rows)
    ranged = df.repartitionByRange(pieces, *order) if pieces > 1 else df.repartition(1)
    return written(ranged.withColumn(name, F.spark_partition_id()), "slices")


def slice_count(rows: int, slice_rows: int = SLICE_ROWS) -> int:
    wanted, needed = -(-rows // slice_rows), -(-rows // max(slice_rows, SLICE_ROWS))
    return max(1, needed, min(wanted, MANY_SLICES))


def value_slices(df: DataFrame, value: str, name: str = "_slice", slices: int | None = None) -> DataFrame:
    """Number slices of one numeric column by approximate quantiles.

    The cut points are literals, so nothing is written and a recomputation
    numbers rows the same way. Equal values always share a slice.
    """
    pieces = min(slices or parallelism(df.sparkSession), 4096)
    shares = [i / pieces for i in range(1, pieces)]
    cuts = sorted(set(df.approxQuantile(value, shares, 1.0 / (4 * pieces)))) if shares else []
    if not cuts:
        return df.withColumn(name, F.lit(0))
    splits = [float("-inf"), *cuts, float("inf")]
    numbered = Bucketizer(splits=splits, inputCol=value, outputCol=name, handleInvalid="keep").transform(df)
    return numbered.withColumn(name, F.col(name).cast("int"))


def _over(item: Running, column: Column, window) -> Column:
    if item.op == "last":
        return F.last(column, ignorenulls=True).over(window)
    return getattr(F, item.op)(column).over(window)


def _frame(window, inclusive: bool):
    return window.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)


def plain_running(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], items: Sequence[Running]) -> DataFrame:
    base, key = Window.partitionBy(*by).orderBy(*order), Window.partitionBy(*by)
    return df.select("*", *[_over(i, i.column, key if i.whole else _frame(base, i.inclusive)).alias(i.name) for i in items])


def sliced_running(df: DataFrame, by: Sequence[str], slice_col: str, order: Sequence[Column | str],
                   items: Sequence[Running], last_by: Sequence[str] = ()) -> DataFrame:
    """Running aggregates with slices as windows and slice totals as carry.

    ``slice_col`` must ascend along ``order``. ``last_by`` names the ascending
    order columns and is needed for ``last`` only. The carry has one row per
    (key, slice).
    """
    inside = Window.partitionBy(*by, slice_col).orderBy(*order)
    local = df.select("*", *[_over(i, i.column, _frame(inside, i.inclusive)).alias(f"_in_{i.name}")
                             for i in items if not i.whole])

    def total(item: Running) -> Column:
        if item.op == "last":
            return F.max_by(item.column, F.when(item.column.isNotNull(), F.struct(*last_by)))
        return getattr(F, item.op)(item.column)

    totals = df.groupBy(*by, slice_col).agg(*[total(i).alias(i.name) for i in items])
    key = Window.partitionBy(*by)
    earlier = key.orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *[F.col(c).alias(f"_key_{c}") for c in (*by, slice_col)],
        *[_over(i, F.col(i.name), key if i.whole else earlier).alias(f"_pre_{i.name}") for i in items])
    same = reduce(Column.__and__, [local[c].eqNullSafe(carry[f"_key_{c}"]) for c in (*by, slice_col)])
    joined = local.join(carry, same, "left")

    def combined(item: Running) -> Column:
        if item.whole:
            return F.col(f"_pre_{item.name}")
        here, before = F.col(f"_in_{item.name}"), F.col(f"_pre_{item.name}")
        if item.op == "sum":
            return F.when(here.isNull(), before).when(before.isNull(), here).otherwise(here + before)
        if item.op == "last":
            return F.coalesce(here, before)
        return (F.least if item.op == "min" else F.greatest)(here, before)

    return joined.select(*[local[c] for c in df.columns], *[combined(i).alias(i.name) for i in items])


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], items: Sequence[Running],
            hot_rows: int = HOT_ROWS, slice_rows: int = SLICE_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """Running aggregates per key in ascending ``order`` (which must be unique per key).

    ``counted`` may name a cheaper frame with the same keys to count.
    """
    hot = hot_keys(df if counted is None else counted, by, hot_rows)
    if hot is None:
        return plain_running(df, by, order, items)
    cold, heavy = split_hot(df, by, hot)
    cut = order_slices(heavy, [*by, *order], hot.rows, slice_rows=slice_rows)
    sliced = sliced_running(cut, by, "_slice", order, items, last_by=order).drop("_slice")
    return plain_running(cold, by, order, items).unionByName(sliced)


def keys_at(df: DataFrame, order: Sequence[str], positions: Sequence[int], low: int, high: int,
            cells: int = 4096) -> list[tuple[int, ...]]:
    """Values of the integer ``order`` columns at 0-based positions of that order.

    Narrows a value range by counting rows per equal cell, so nothing is sorted
    and a pass shuffles no more than ``cells`` counts per task; the filters of
    later passes reach the scan. A cell of at most ``cells`` rows is read out.
    ``low`` and ``high`` bound the first column. ``order`` must be unique; passes
    per column are at most log(range) / log(cells).
    """
    seen: dict[tuple, list] = {}
    return [_key_at(df, order, p, low, high, cells, seen) for p in positions]


def _key_at(df: DataFrame, order: Sequence[str], position: int, low: int, high: int, cells: int,
            seen: dict[tuple, list]) -> tuple[int, ...]:
    found: list[int] = []
    scope = df
    for name, following in zip(order, [*order[1:], None]):
        bounds = None
        while low < high:
            width = -(-(high - low + 1) // cells)
            step = (*found, low, high)
            if step not in seen:
                rest = [F.min(following).alias("low"), F.max(following).alias("high")] if following else []
                seen[step] = (scope.where(F.col(name).between(low, high))
                              .groupBy(F.expr(f"(`{name}` - ({low}L)) div {width}L").alias("cell"))
                              .agg(F.count(F.lit(1)).alias("n"), *rest).orderBy("cell").collect())
            for row in seen[step]:
                if position < row["n"]:
                    break
                position -= row["n"]
            low, high = low + row["cell"] * width, min(high, low + (row["cell"] + 1) * width - 1)
            if row["n"] <= cells:
                rest = order[len(found):]
                few = scope.where(F.col(name).between(low, high)).select(*rest).orderBy(*rest).collect()
                return (*found, *few[position])
            bounds = (row["low"], row["high"]) if following and low == high else None
        found.append(low)
        if following:
            scope = scope.where(F.col(name) == low)
            low, high = bounds or tuple(scope.agg(F.min(following), F.max(following)).first())
    return tuple(found)
