"""Behaviour features at arrival, with per-user state.

Equal to the batch features when rows arrive in time order and a user's rows of
one second arrive in one batch. The state of a user is bounded: one entry per
second of the widest window, one per device, and a few numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from riskloom.operators.behaviour import FeatureSpec

STATE = T.StructType([
    T.StructField("seconds", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.LongType())),
    T.StructField("known", T.ArrayType(T.LongType())), T.StructField("sums", T.ArrayType(T.LongType())),
    T.StructField("n", T.LongType()), T.StructField("n_amt", T.LongType()), T.StructField("total", T.StringType()),
    T.StructField("squares", T.StringType()), T.StructField("last_time", T.LongType()),
    T.StructField("last_place", T.DoubleType()), T.StructField("last_change", T.LongType()),
    T.StructField("devices", T.ArrayType(T.StringType())), T.StructField("first_seen", T.ArrayType(T.LongType())),
])
EMPTY = ([], [], [], [], 0, 0, "0", "0", None, None, None, [], [])
NEVER = np.iinfo(np.int64).min


def output_schema(spec: FeatureSpec, id_type: T.DataType, key_type: T.DataType) -> T.StructType:
    doubles = {*spec.sum_widths, f"avg_amt_per_{spec.key}", f"std_amt_per_{spec.key}", "amt_vs_avg_ratio"}
    names = [*spec.count_widths, "time_since_last_tx", *spec.sum_widths, f"cnt_per_{spec.key}",
             f"avg_amt_per_{spec.key}", f"std_amt_per_{spec.key}", "amt_vs_avg_ratio",
             "time_since_last_geo_change", f"is_new_device_{spec.key}"]
    head = [T.StructField(spec.id, id_type), T.StructField(spec.time, T.LongType()),
            T.StructField(spec.amount, T.DoubleType()), T.StructField(spec.key, key_type)]
    return T.StructType(head + [T.StructField(n, T.DoubleType() if n in doubles else T.LongType()) for n in names])


def stream_features(stream: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """id, time, amount, key and the features of every arriving row. ``place`` must be numeric."""
    device = F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")).alias(c) for c in spec.device]))
    narrow = stream.select(spec.id, spec.time, spec.amount, spec.key, spec.units.alias("_units"),
                           F.col(spec.place).cast("double").alias("_place"), device.alias("_device"))
    schema = output_schema(spec, stream.schema[spec.id].dataType, stream.schema[spec.key].dataType)

    def advance(key: tuple[Any, ...], chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(chunks), ignore_index=True).sort_values([spec.time, spec.id], kind="stable")
        out, after = _advance(rows, state.get if state.exists else EMPTY, spec)
        state.update(after)
        yield out[[f.name for f in schema]]

    return narrow.groupBy(spec.key).applyInPandasWithState(advance, schema, STATE, "append", GroupStateTimeout.NoTimeout)


def _running(before: int, values: np.ndarray) -> np.ndarray:
    """Exact totals before each value, and after the last one."""
    return np.concatenate([[before], before + np.cumsum(values)]) if len(values) else np.array([before], dtype=object)


def _advance(rows: pd.DataFrame, state: tuple, spec: FeatureSpec) -> tuple[pd.DataFrame, tuple]:
    """Features of one user's new rows, sorted by time, and the state after them."""
    given = {c: rows[c].to_numpy() for c in (spec.id, spec.time, spec.amount, spec.key)}
    out, after = advance_arrays(given, rows["_units"].notna().to_numpy(), rows["_units"].fillna(0).to_numpy(dtype=np.int64),
                                rows["_place"].to_numpy(dtype=float), rows["_device"].tolist(), state, spec)
    out[SINCE] = pd.arrays.IntegerArray(*out[SINCE])
    return pd.DataFrame(out), after


SINCE = "time_since_last_geo_change"


def advance_arrays(given: dict[str, np.ndarray], has: np.ndarray, units: np.ndarray, place: np.ndarray, shown: list,
                   state: tuple, spec: FeatureSpec) -> tuple[dict, tuple]:
    """``_advance`` on arrays: id, time, amount and key, whether there are units, units, places, devices. ``SINCE`` comes with its gaps."""
    (seconds, counts, known, sums, n, n_amt, total, squares, last_time, last_place, last_change, devices, first_seen) = state
    time = given[spec.time].astype(np.int64)
    scale = float(10 ** spec.amount_scale)
    out = dict(given)

    # Ranges: one entry per second, old and new, with running totals.
    at, slot = np.unique(np.concatenate([np.array(seconds, dtype=np.int64), time]), return_inverse=True)

    def per_second(old: list[int], new: np.ndarray) -> np.ndarray:
        totals = np.zeros(len(at), dtype=np.int64)
        np.add.at(totals, slot, np.concatenate([np.array(old, dtype=np.int64), new]))
        return totals

    stream = {"c": per_second(counts, np.ones_like(time)), "k": per_second(known, has.astype(np.int64)),
              "u": per_second(sums, units)}
    upto = {c: np.concatenate([[0], v.cumsum()]) for c, v in stream.items()}
    right = np.searchsorted(at, time, "right")

    def moving(column: str, width: int) -> np.ndarray:
        return upto[column][right] - upto[column][np.searchsorted(at, time - width, "left")]

    for name, width in spec.count_widths.items():
        out[name] = moving("c", width)
    for name, width in spec.sum_widths.items():
        out[name] = np.where(moving("k", width) > 0, moving("u", width) / scale, np.nan)

    # History: strictly earlier rows.
    numbers = n_amt + np.concatenate([[0], np.cumsum(has)])
    totals = _running(int(total), units.astype(object))
    moments = _running(int(squares), units.astype(object) ** 2)
    prior, m = totals[:-1], numbers[:-1]
    mean = np.array([t / k / scale if k > 0 else np.nan for t, k in zip(prior, m)], dtype=float)
    spread = [float(k * q - t * t) / (k * (k - 1)) if k > 1 else np.nan for t, q, k in zip(prior, moments, map(int, m))]
    out[f"cnt_per_{spec.key}"] = n + np.arange(len(time))
    out[f"avg_amt_per_{spec.key}"] = mean
    out[f"std_amt_per_{spec.key}"] = np.sqrt(np.array(spread, dtype=float)) / scale
    out["amt_vs_avg_ratio"] = out[spec.amount] / (mean + 1.0)

    # The row before: gap and change of place.
    previous = np.concatenate([[time[0] if last_time is None else last_time], time[:-1]])
    out["time_since_last_tx"] = time - previous
    before = np.concatenate([[np.nan if last_place is None else last_place], place[:-1]])
    changed = ~np.isnan(place) & ~np.isnan(before) & (place != before)
    latest = np.maximum.accumulate(np.where(changed, time, NEVER if last_change is None else last_change))
    latest = latest[np.searchsorted(time, time, "right") - 1]  # rows of the same second see its change
    never = latest == NEVER
    out[SINCE] = (time - np.where(never, 0, latest), never)

    # Devices: the first second each was seen.
    seen = dict(zip(devices, first_seen))
    for device, second in zip(shown, time.tolist()):
        seen[device] = min(second, seen.get(device, second))
    out[f"is_new_device_{spec.key}"] = (np.array([seen[d] for d in shown]) == time).astype(np.int64)

    keep = at >= time[-1] - max([*spec.count_widths.values(), *spec.sum_widths.values()])
    after = (at[keep].tolist(), *(stream[c][keep].tolist() for c in "cku"),
             int(n + len(time)), int(numbers[-1]), str(totals[-1]), str(moments[-1]), int(time[-1]),
             None if np.isnan(place[-1]) else float(place[-1]),
             None if latest[-1] == NEVER else int(latest[-1]), list(seen), [int(v) for v in seen.values()])
    return out, after
