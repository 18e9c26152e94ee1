"""Point-in-time behaviour of a user: velocity, history, gaps, places, devices.

Frames follow two rules. Velocity and place features see rows up to and
including the current second (peers included). History features see strictly
earlier rows in (time, id) order, missing ids last, never the current one, so
that a feature cannot leak the row it describes.

A moving range is computed as the difference of two growing ranges,
``upto(t) - upto(t - width - 1)``: Spark extends a growing frame once per row,
while it would re-aggregate a moving frame for every row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import ascending, exact_mean, exact_std, fixed_point, square
from riskloom.operators.ordering import (
    HOT_ROWS, SLICE_ROWS, HotKeys, Running, hot_keys, order_slices, sliced_running, split_hot)
from riskloom.session import written

# Window widths in seconds and the names of their columns.
COUNT_WIDTHS = {"cnt_5m": 300, "cnt_1h": 3600, "cnt_24h": 86400, "cnt_7d": 604800}
SUM_WIDTHS = {"amt_1h": 3600}

VELOCITY, AMOUNT, HISTORY, GAP, PLACE, DEVICE = "velocity", "amount", "history", "gap", "place", "device"
ALL_PARTS = (VELOCITY, AMOUNT, HISTORY, GAP, PLACE, DEVICE)

# Shortest time slice of a hot key, in seconds.
SLICE_SECONDS = 86_400


@dataclass(frozen=True)
class FeatureSpec:
    """Column names and parameters.

    ``time`` counts whole seconds and ``id`` is unique; both are never NULL.
    Sums and deviations take amounts to ``amount_scale`` decimals.
    """

    id: str = "TransactionID"
    time: str = "TransactionDT"
    amount: str = "TransactionAmt"
    key: str = "uid1"
    place: str = "addr1"
    device: tuple[str, ...] = ("DeviceInfo", "DeviceType")
    amount_scale: int = 3
    count_widths: Mapping[str, int] = field(default_factory=lambda: dict(COUNT_WIDTHS))
    sum_widths: Mapping[str, int] = field(default_factory=lambda: dict(SUM_WIDTHS))
    hot_rows: int = HOT_ROWS
    slice_rows: int = SLICE_ROWS

    @property
    def units(self) -> Column:
        return fixed_point(F.col(self.amount), self.amount_scale)

    def feature_names(self, parts: Iterable[str]) -> list[str]:
        names = {
            VELOCITY: list(self.count_widths),
            GAP: ["time_since_last_tx"],
            AMOUNT: list(self.sum_widths),
            HISTORY: [f"cnt_per_{self.key}", f"avg_amt_per_{self.key}", f"std_amt_per_{self.key}"],
            PLACE: ["geo_change_dt", "time_since_last_geo_change"],
            DEVICE: [f"is_new_device_{self.key}"],
        }
        return [n for part in names if part in parts for n in names[part]]


def behaviour(df: DataFrame, spec: FeatureSpec = FeatureSpec(), parts: Iterable[str] = ALL_PARTS,
              counted: DataFrame | None = None) -> DataFrame:
    """All rows and columns of ``df`` plus the features of ``parts``.

    Heavy users are counted first. ``counted`` may name a cheaper frame with the
    same keys, such as the transactions before a join.
    """
    wanted = tuple(parts)
    if unknown := set(wanted) - set(ALL_PARTS):
        raise ValueError(f"unknown feature parts: {sorted(unknown)}")
    hot = hot_keys(df if counted is None else counted, [spec.key], spec.hot_rows)
    if hot is None:
        return _by_user(df, spec, wanted)
    cold, heavy = split_hot(df, [spec.key], hot)
    return _by_user(cold, spec, wanted).unionByName(_by_slice(heavy, hot, spec, wanted))


def velocity_counts(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    return behaviour(df, spec, [VELOCITY])


def velocity_sums(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    return behaviour(df, spec, [AMOUNT])


def history_stats(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    return behaviour(df, spec, [HISTORY])


def since_last(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    return behaviour(df, spec, [GAP])


def since_place_change(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """The change point of a row itself and the seconds since the latest one."""
    return behaviour(df, spec, [PLACE])


def first_sighting(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """1 when the user showed this device in no strictly earlier second, else 0."""
    return behaviour(df, spec, [DEVICE])


def amount_ratio(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """Amount against the user's earlier mean; NULL for the first row."""
    return df.withColumn("amt_vs_avg_ratio", F.col(spec.amount) / (F.col(f"avg_amt_per_{spec.key}") + F.lit(1.0)))


def _history_columns(spec: FeatureSpec) -> dict[str, Column]:
    n, total, squares = F.col("_n_amt"), F.col("_sum_amt"), F.col("_sq_amt")
    return {
        f"avg_amt_per_{spec.key}": exact_mean(total, n, spec.amount_scale),
        f"std_amt_per_{spec.key}": exact_std(total, squares, n, spec.amount_scale),
    }


def _by_user(df: DataFrame, spec: FeatureSpec, parts: tuple[str, ...]) -> DataFrame:
    """One shuffle by user. The (time, id) windows run first, so that the time-only windows reuse their sort."""
    time = F.col(spec.time)
    units = F.col("_units")
    in_order = Window.partitionBy(spec.key).orderBy(F.col(spec.time), ascending(spec.id))
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    by_time = Window.partitionBy(spec.key).orderBy(spec.time)
    upto = by_time.rangeBetween(Window.unboundedPreceding, 0)

    def timed(column: Column) -> Column:
        return F.when(time.isNotNull(), column)

    out = df.withColumn("_units", spec.units)
    first: dict[str, Column] = {}
    if HISTORY in parts:
        first |= {
            f"cnt_per_{spec.key}": F.count(time).over(earlier),
            "_n_amt": F.count(timed(units)).over(earlier),
            "_sum_amt": F.sum(timed(units)).over(earlier),
            "_sq_amt": F.sum(timed(square(units))).over(earlier),
        }
    if GAP in parts:
        first["time_since_last_tx"] = F.coalesce(time - F.lag(spec.time).over(in_order), F.lit(0).cast("bigint"))
    if PLACE in parts:
        first["geo_change_dt"] = F.when(F.col(spec.place) != F.lag(timed(F.col(spec.place))).over(in_order), time)
    if first:
        out = out.withColumns(first)
    if HISTORY in parts:
        out = out.withColumns(_history_columns(spec)).drop("_n_amt", "_sum_amt", "_sq_amt")

    def moving(function, width: int) -> Column:
        return function.over(upto) - function.over(by_time.rangeBetween(Window.unboundedPreceding, -(width + 1)))

    second: dict[str, Column] = {}
    if VELOCITY in parts:
        second |= {name: moving(F.count(F.lit(1)), width) for name, width in spec.count_widths.items()}
    if AMOUNT in parts:
        for name, width in spec.sum_widths.items():
            total = F.sum(units)
            older = F.coalesce(
                total.over(by_time.rangeBetween(Window.unboundedPreceding, -(width + 1))), F.lit(0).cast("bigint"))
            second[name] = F.when(moving(F.count(units), width) > 0,
                                  (total.over(upto) - older).cast("double") / float(10 ** spec.amount_scale))
    if PLACE in parts:
        second["time_since_last_geo_change"] = time - F.max("geo_change_dt").over(upto)
    if second:
        out = out.withColumns(second)
    if DEVICE in parts:
        seen = F.min(spec.time).over(Window.partitionBy(spec.key, *spec.device))
        out = out.withColumn(f"is_new_device_{spec.key}", _is_first(time, seen))
    # Rows without a time are part of no history and have none.
    return out.select(*df.columns, *[timed(F.col(n)).alias(n) for n in spec.feature_names(parts)])


def _is_first(time: Column, seen: Column) -> Column:
    return F.when(time == seen, 1).otherwise(0).cast("bigint")


def _by_slice(df: DataFrame, hot: HotKeys, spec: FeatureSpec, parts: tuple[str, ...]) -> DataFrame:
    """The same features for users too heavy for one task.

    Narrow columns only, joined back on a row number that is written with the
    rows, so ids may be missing or repeat. Three steps: earlier-row features over range-partitioned slices of (time, id); range
    features over one row per (user, second) in slices of a day; first sightings
    by a plain aggregate.
    """
    key, time, row_id = spec.key, spec.time, spec.id
    devices = list(spec.device) if DEVICE in parts else []
    places = [spec.place] if PLACE in parts else []
    keyed = written(df.withColumn("_row", F.monotonically_increasing_id()), "hot_rows")
    narrow = keyed.where(F.col(time).isNotNull()).select(
        "_row", row_id, F.col(row_id).isNull().alias("_no_id"), key, time, spec.units.alias("_units"),
        *dict.fromkeys([*places, *devices]))
    out = narrow

    if {HISTORY, GAP, PLACE} & set(parts):
        one = F.lit(1).cast("bigint")
        items: list[Running] = []
        if HISTORY in parts:
            items += [Running(f"cnt_per_{key}", "sum", one, False),
                      Running("_n_amt", "sum", F.col("_units").isNotNull().cast("bigint"), False),
                      Running("_sum_amt", "sum", F.col("_units"), False),
                      Running("_sq_amt", "sum", square(F.col("_units")), False)]
        if GAP in parts or PLACE in parts:
            items.append(Running("_last", "last", F.struct(time, *places), False))
        order = [time, "_no_id", row_id, "_row"]
        cut = order_slices(narrow, [key, *order], hot.rows, slice_rows=spec.slice_rows)
        out = sliced_running(cut, [key], "_slice", order, items, last_by=order).drop("_slice")
        if HISTORY in parts:
            out = out.withColumn(f"cnt_per_{key}", F.coalesce(F.col(f"cnt_per_{key}"), F.lit(0).cast("bigint")))
            out = out.withColumns(_history_columns(spec)).drop("_n_amt", "_sum_amt", "_sq_amt")
        if GAP in parts:
            out = out.withColumn("time_since_last_tx",
                                 F.coalesce(F.col(time) - F.col(f"_last.{time}"), F.lit(0).cast("bigint")))
        if PLACE in parts:
            out = out.withColumn("geo_change_dt",
                                 F.when(F.col(spec.place) != F.col(f"_last.{spec.place}"), F.col(time)))
        out = out.drop("_last")

    if {VELOCITY, AMOUNT, PLACE} & set(parts):
        seconds = _range_features(out, spec, parts)
        same = out[key].eqNullSafe(seconds["_key"]) & (out[time] == seconds["_time"])
        out = out.join(seconds, same).drop("_key", "_time")
    if DEVICE in parts:
        firsts = narrow.groupBy(key, *devices).agg(F.min(time).alias("_first"))
        firsts = firsts.withColumnsRenamed({c: f"_dev_{c}" for c in (key, *devices)})
        same = reduce(Column.__and__, [out[c].eqNullSafe(firsts[f"_dev_{c}"]) for c in (key, *devices)])
        out = out.join(firsts, same).withColumn(f"is_new_device_{key}", _is_first(F.col(time), F.col("_first")))

    features = spec.feature_names(parts)
    return keyed.join(out.select("_row", *features), "_row", "left").select(*df.columns, *features)


def _range_features(rows: DataFrame, spec: FeatureSpec, parts: tuple[str, ...]) -> DataFrame:
    """Range features per (user, second).

    All rows of a second share them, so rows are first summed per second. Time
    is cut into slices as long as the widest window; a slice sees its own
    seconds and, as a halo, those of the slice before, which is all a window can
    reach. That is at most two entries per second of the width, however many
    rows a user has. The latest change of place has no such limit: slices
    further back hand on their maximum.
    """
    key, time = spec.key, spec.time
    widths = {**(spec.count_widths if VELOCITY in parts else {}), **(spec.sum_widths if AMOUNT in parts else {})}
    length = max([*widths.values(), SLICE_SECONDS]) + 1
    per_second = rows.groupBy(key, time).agg(
        F.count(F.lit(1)).alias("_n"), F.count("_units").alias("_m"),
        F.coalesce(F.sum("_units"), F.lit(0).cast("bigint")).alias("_s"),
        *([F.max("geo_change_dt").alias("_g")] if PLACE in parts else []))
    per_second = per_second.withColumnsRenamed({key: "_key", time: "_time"}).withColumn(
        "_own", F.floor(F.col("_time") / F.lit(length)).cast("bigint"))

    seen_by = F.array("_own", F.col("_own") + 1) if widths else F.array("_own")
    slices = per_second.withColumn("_slice", F.explode(seen_by))
    by_time = Window.partitionBy("_key", "_slice").orderBy("_time")
    upto = by_time.rangeBetween(Window.unboundedPreceding, 0)

    def moving(name: str, width: int) -> Column:
        older = F.sum(name).over(by_time.rangeBetween(Window.unboundedPreceding, -(width + 1)))
        return F.sum(name).over(upto) - F.coalesce(older, F.lit(0).cast("bigint"))

    found: dict[str, Column] = {}
    if VELOCITY in parts:
        found |= {name: moving("_n", width) for name, width in spec.count_widths.items()}
    if AMOUNT in parts:
        found |= {name: F.when(moving("_m", width) > 0, moving("_s", width).cast("double") / float(10 ** spec.amount_scale))
                  for name, width in spec.sum_widths.items()}
    if PLACE in parts:
        found["_latest"] = F.max("_g").over(upto)
    own = slices.withColumns(found).where(F.col("_slice") == F.col("_own"))
    if PLACE not in parts:
        return own.select("_key", "_time", *found)

    changes = per_second.groupBy("_key", "_own").agg(F.max("_g").alias("_g"))
    earlier = Window.partitionBy("_key").orderBy("_own").rowsBetween(Window.unboundedPreceding, -1)
    carry = changes.select(F.col("_key").alias("_c_key"), F.col("_own").alias("_c_own"), F.max("_g").over(earlier).alias("_before"))
    joined = own.join(carry, own["_key"].eqNullSafe(carry["_c_key"]) & (own["_slice"] == carry["_c_own"]))
    since = F.col("_time") - F.greatest("_latest", "_before")
    return joined.select("_key", "_time", *[n for n in found if n != "_latest"], since.alias("time_since_last_geo_change"))
