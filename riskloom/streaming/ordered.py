"""Behaviour features of rows that arrive out of order.

Users are dealt into buckets. A bucket's rows wait in list state, one Arrow table
per arriving chunk, until the watermark has passed them, and are then worked off
user by user in time order, so the features equal the batch ones however rows
were shuffled within the delay. One event-time timer per bucket stands at the
earliest waiting row. History is map state, one entry of bounded size per user,
read and written only if the user has rows; devices beyond ``INLINE`` of a user
are entries of their own. Rows behind the watermark never reach the state
(``runs.run_with_late`` sets them aside), and no watermark passes rows without a time.

With ``expire_after`` seconds a user's history is forgotten once no row has come
for that long in event time; the next row then starts a new one. Without it,
state grows with the users and their devices, never with their rows. A task
holds the waiting rows of one bucket. Needs the RocksDB state store
(``STATE_STORE``).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskloom.operators.behaviour import FeatureSpec
from riskloom.streaming.behaviour import EMPTY, SINCE, STATE, advance_arrays, output_schema

STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
DEVICE, SEEN = len(EMPTY) - 2, len(EMPTY) - 1
LAST_TIME = 8
# Buckets of users by default, and devices that a user's history holds itself.
BUCKETS, INLINE = 1024, 64


class OrderedFeatures(StatefulProcessor):
    def __init__(self, spec: FeatureSpec, schema: T.StructType, waiting: T.StructType, expire_after: int | None):
        self.spec, self.schema, self.waiting, self.expire_after = spec, schema, waiting, expire_after

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.arrow = handle, to_arrow_schema(self.waiting)
        user = T.StructField("user", self.waiting[self.spec.key].dataType)
        self.rows = handle.getListState("rows", T.StructType([T.StructField("chunk", T.BinaryType())]))
        self.history = handle.getMapState("history", T.StructType([user]), STATE)
        self.devices = handle.getMapState("devices", T.StructType([user, T.StructField("device", T.StringType())]),
                                          T.StructType([T.StructField("first_seen", T.LongType())]))
        # The earliest moment at which some history may expire.
        self.next_end = handle.getValueState("next_end", T.StructType([T.StructField("at", T.LongType())]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        earliest, parts = None, []
        for chunk in rows:
            if len(chunk):
                parts.append((self._packed(pa.Table.from_pandas(chunk[self.arrow.names], self.arrow, preserve_index=False)),))
                low = int(chunk[self.spec.time].min())
                earliest = low if earliest is None else min(earliest, low)
        if earliest is not None:
            self.rows.appendList(parts)
            self._wake(earliest * 1000)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() // 1000
        parts = [pa.ipc.open_stream(bytes(r[0])).read_all() for r in self.rows.get()] if self.rows.exists() else []
        waiting = pa.concat_tables(parts) if parts else self.arrow.empty_table()
        passed = pc.less_equal(waiting.column(self.spec.time), now)
        ready, later = waiting.filter(passed), waiting.filter(pc.invert(passed))
        if len(ready):
            if len(later):
                self.rows.put([(self._packed(later),)])
            else:
                self.rows.clear()
            yield self._features(ready)
        moments = [pc.min(later.column(self.spec.time)).as_py()] if len(later) else []
        if self.expire_after is not None:
            moments += self._expire(now)
        if moments:
            self._wake(min(moments) * 1000, expiredTimerInfo)

    def _packed(self, table: pa.Table) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.arrow) as writer:
            writer.write_table(table)
        return sink.getvalue().to_pybytes()

    def _wake(self, at: int, expired: Any = None) -> None:
        """One timer, at the earliest moment asked for; the one that has just gone off is still listed."""
        gone = expired.getExpiryTimeInMs() if expired is not None else None
        present = [t for t in self.handle.listTimers() if t != gone]
        if any(t <= at for t in present):
            return
        for t in present:
            self.handle.deleteTimer(t)
        self.handle.registerTimer(at)

    def _expire(self, now: int) -> list[int]:
        """Forgets what has expired; the next moment to look again."""
        if not self.next_end.exists():
            return []
        end = self.next_end.get()[0]
        if end <= now:
            ends = [(user, value[LAST_TIME] + self.expire_after) for user, value in self.history.iterator()]
            for user, at in ends:
                if at <= now:
                    self._forget(user[0])
            end = min((at for _, at in ends if at > now), default=None)
            if end is None:
                self.next_end.clear()
                return []
            self.next_end.update((end,))
        return [end]

    def _forget(self, user: Any) -> None:
        value = self.history.getValue((user,))
        self.history.removeKey((user,))
        if len(value[DEVICE]) >= INLINE:
            for k in [k for k in self.devices.keys() if k[0] == user]:
                self.devices.removeKey(tuple(k))

    def _features(self, ready: pa.Table) -> pd.DataFrame:
        spec = self.spec
        frame = ready.select([spec.key, spec.time, spec.id]).to_pandas()
        frame["_at"] = np.arange(len(frame))
        order = frame.sort_values([spec.key, spec.time, spec.id], kind="stable")["_at"].to_numpy()
        ready = ready.take(pa.array(order))
        # Whole units travel as text: a column with gaps would reach pandas as floats.
        units = ready.column("w_units").cast(pa.int64())
        has, units = units.is_valid().to_numpy(), units.fill_null(0).to_numpy()
        place = ready.column("w_place").to_pandas().to_numpy(dtype=float)
        device = ready.column("w_device").to_pylist()
        given = {c: ready.column(c).to_pandas().to_numpy() for c in (spec.id, spec.time, spec.amount, spec.key)}
        given[spec.amount] = given[spec.amount].astype(float)
        users = ready.column(spec.key).to_pylist()
        begins = [i for i in range(len(users)) if i == 0 or users[i] != users[i - 1]]
        parts, last = [], None
        for a, b in zip(begins, [*begins[1:], len(users)]):
            own = {c: v[a:b] for c, v in given.items()}
            out, end = self._user(users[a], own, has[a:b], units[a:b], place[a:b], device[a:b])
            parts.append(out)
            last = end if last is None else min(last, end)
        if self.expire_after is not None:
            end = last + self.expire_after
            if not self.next_end.exists() or end < self.next_end.get()[0]:
                self.next_end.update((end,))
        whole = {c: np.concatenate([p[c] for p in parts]) for c in parts[0] if c != SINCE}
        whole[SINCE] = pd.arrays.IntegerArray(*(np.concatenate([p[SINCE][i] for p in parts]) for i in range(2)))
        return pd.DataFrame(whole)[[f.name for f in self.schema]]

    def _user(self, user: Any, given: dict, has: np.ndarray, units: np.ndarray, place: np.ndarray, shown: list) -> tuple[dict, int]:
        """Features of a user's rows in time order, and the time of the last one."""
        before = tuple(self.history.getValue((user,))) if self.history.containsKey((user,)) else EMPTY
        if self.expire_after is not None and before[LAST_TIME] is not None and int(given[self.spec.time][0]) - before[LAST_TIME] >= self.expire_after:
            self._forget(user)
            before = EMPTY
        known = dict(zip(before[DEVICE], before[SEEN]))
        stored = {}
        if len(known) >= INLINE:
            for device in dict.fromkeys(shown):
                if device not in known and self.devices.containsKey((user, device)):
                    stored[device] = self.devices.getValue((user, device))[0]
        known |= stored
        out, after = advance_arrays(given, has, units, place, shown, (*before[:DEVICE], list(known), list(known.values())), self.spec)
        seen = list(zip(after[DEVICE], after[SEEN]))
        self.history.updateValue((user,), (*after[:DEVICE], [d for d, _ in seen[:INLINE]], [t for _, t in seen[:INLINE]]))
        for device, first in seen[INLINE:]:
            if stored.get(device) != first:
                self.devices.updateValue((user, device), (first,))
        return out, after[LAST_TIME]

    def close(self) -> None:
        pass


def ordered_features(stream: DataFrame, spec: FeatureSpec = FeatureSpec(), delay: str = "1 hour",
                     expire_after: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """id, time, amount, key and features of every row, once the watermark (``delay`` behind the latest row) has passed it."""
    device = F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")).alias(c) for c in spec.device]))
    # Names that begin with an underscore would be lost on the way to the processor.
    narrow = stream.where(F.col(spec.time).isNotNull()).select(
        spec.id, spec.time, spec.amount, spec.key, spec.units.cast("string").alias("w_units"),
        F.col(spec.place).cast("double").alias("w_place"), device.alias("w_device"),
        F.timestamp_seconds(F.col(spec.time)).alias("w_event_time")).withWatermark("w_event_time", delay)
    schema = output_schema(spec, stream.schema[spec.id].dataType, stream.schema[spec.key].dataType)
    waiting = T.StructType([f for f in narrow.schema if f.name != "w_event_time"])
    return narrow.withColumn("w_bucket", F.pmod(F.xxhash64(spec.key), F.lit(buckets))).groupBy("w_bucket").transformWithStateInPandas(
        OrderedFeatures(spec, schema, waiting, expire_after), schema, "append", "eventtime")
