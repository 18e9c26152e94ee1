import random

import pytest
from pyspark.sql import functions as F

from riskloom.catalog.inputs import SPEC, table, transactions_from
from riskloom.operators.behaviour import amount_ratio, behaviour
from riskloom.operators.columns import user_keys
from riskloom.operators.decisions import decide, fallback_fraud, huge_amount_from_new_device
from riskloom.plans.features import build_features
from riskloom.streaming.behaviour import stream_features
from riskloom.streaming.ordered import STATE_STORE, ordered_features
from riskloom.streaming.runs import drop_replays, read_stream, run_available, run_with_late


def files_in_time_order(spark, sf_dir, path, parts=4):
    """The events as ``parts`` files, written one after the other."""
    events = table(spark, sf_dir, "events")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    step = (high - low) // parts + 1
    for i in range(parts):
        part = events.where(F.col("event_id").between(low + i * step, low + (i + 1) * step - 1))
        part.coalesce(1).write.mode("append").parquet(path)
    return events


def rows(df, names):
    return sorted(repr(tuple(r)) for r in df.select(*names).collect())


def test_features_over_several_batches(spark, sf_dir, tmp_path):
    events = files_in_time_order(spark, sf_dir, str(tmp_path / "in"))
    batch = build_features(transactions_from(events), spec=SPEC)
    stream = read_stream(spark, str(tmp_path / "in"), "*.parquet", events.schema, files_per_trigger=1)
    streamed = run_available(stream_features(user_keys(transactions_from(stream)), SPEC), "features")
    assert rows(streamed, streamed.columns) == rows(batch, streamed.columns)


def test_peers_and_nulls_in_one_batch(spark, tmp_path):
    data = [(i, "u", t, a, p, d, "m") for i, (t, a, p, d) in enumerate([
        (10, 1.0, 1.0, "a"), (10, None, 2.0, "a"), (400, 3.0, None, None), (400, 4.0, 3.0, None), (700000, 5.0, 3.0, "a")])]
    df = spark.createDataFrame(data, "TransactionID bigint, uid1 string, TransactionDT bigint, TransactionAmt double, "
                                     "addr1 double, DeviceInfo string, DeviceType string")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = read_stream(spark, str(tmp_path / "in"), "*.parquet", df.schema)
    streamed = run_available(stream_features(stream, SPEC), "features")
    batch = amount_ratio(behaviour(df, SPEC), SPEC)
    assert rows(streamed, streamed.columns) == rows(batch, streamed.columns)


def test_decisions_equal_batch(spark, sf_dir, tmp_path):
    events = files_in_time_order(spark, sf_dir, str(tmp_path / "in"), 2)

    def decided(df):
        tx = transactions_from(df).withColumns({"prob": F.col("C1") / 100.0, "is_new_device_uid1": F.lit(1)})
        return decide(tx, 0.5, [huge_amount_from_new_device(above=100)], fallback=fallback_fraud(above=60))

    stream = read_stream(spark, str(tmp_path / "in"), "*.parquet", events.schema)
    streamed = run_available(decided(stream), "decisions")
    assert rows(streamed, streamed.columns) == rows(decided(events), streamed.columns)


def test_replays_across_batches(spark, sf_dir, tmp_path):
    path = str(tmp_path / "in")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.coalesce(1).write.mode("append").parquet(path)
    events.coalesce(1).write.mode("append").parquet(path)
    stream = read_stream(spark, path, "*.parquet", events.schema, files_per_trigger=1)
    once = run_available(drop_replays(stream, "ts", "event_id", "60 days"), "events")
    assert once.count() == events.count() == once.select("event_id").distinct().count()


SCHEMA = ("TransactionID bigint, uid1 string, TransactionDT bigint, TransactionAmt double, addr1 double, DeviceInfo string, "
          "DeviceType string")


def arriving(spark, path, batches):
    """One file per batch, in order."""
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return read_stream(spark, path, "*.parquet", spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)


@pytest.fixture
def state_store(spark):
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    yield
    for name in STATE_STORE:
        spark.conf.unset(name)


def disordered(seed, n=250, delay=1000):
    """Rows with gaps, ties and NULLs in an order that never lags more than ``delay`` behind, in five batches."""
    draw = random.Random(seed)
    rows = [(i, f"u{draw.randrange(4)}", draw.randrange(20_000), draw.choice([None, 1.25, 3.5, 1e9]), draw.choice([None, 1.0, 2.0]),
             draw.choice([None, "a", "b"]), draw.choice(["m", None])) for i in range(n)]
    order = sorted(rows, key=lambda r: r[2] + draw.randrange(delay))
    return rows, [order[i * n // 5:(i + 1) * n // 5] for i in range(5)]


@pytest.mark.parametrize("seed", [1, 2])
def test_disorder_within_the_delay(spark, tmp_path, state_store, seed):
    rows, batches = disordered(seed)
    stream = arriving(spark, str(tmp_path / "in"), batches)
    streamed = run_available(ordered_features(stream, SPEC, "1000 seconds"), "ordered")
    passed = max(r[2] for r in rows) - 1000
    batch = amount_ratio(behaviour(spark.createDataFrame(rows, SCHEMA), SPEC), SPEC).where(F.col("TransactionDT") <= passed)
    found = [tuple(r) for r in streamed.collect()]
    assert len(found) == len({r[0] for r in found})
    assert sorted(map(repr, found)) == sorted(repr(tuple(r)) for r in batch.select(*streamed.columns).collect())


def test_rows_behind_the_watermark_change_nothing(spark, tmp_path, state_store):
    rows, batches = disordered(3)
    late = [(10_000 + i, "u1", 5, 7.0, 1.0, "z", "m") for i in range(3)]
    stream = arriving(spark, str(tmp_path / "in"), [*batches[:4], batches[4] + late])
    streamed = run_available(ordered_features(stream, SPEC, "1000 seconds"), "ordered")
    passed = max(r[2] for r in rows) - 1000
    batch = amount_ratio(behaviour(spark.createDataFrame(rows, SCHEMA), SPEC), SPEC).where(F.col("TransactionDT") <= passed)
    assert sorted(repr(tuple(r)) for r in streamed.collect()) == sorted(repr(tuple(r)) for r in batch.select(*streamed.columns).collect())


def test_history_expires(spark, tmp_path, state_store):
    def row(i, t, user="u"):
        return (i, user, t + 1000, 1.0, 1.0, "a", "m")
    batches = [[row(0, 0), row(1, 100)], [row(2, 5000, "v")], [row(3, 9000), row(4, 9100)], [row(5, 50_000, "v")]]
    for expire, expected in ((1000, {0: 0, 1: 1, 3: 0, 4: 1, 2: 0}), (None, {0: 0, 1: 1, 3: 2, 4: 3, 2: 0})):
        stream = arriving(spark, str(tmp_path / f"in{expire}"), batches)
        found = run_available(ordered_features(stream, SPEC, "10 seconds", expire), "ordered").collect()
        assert {r["TransactionID"]: r["cnt_per_uid1"] for r in found} == expected
        assert {r["TransactionID"]: r["is_new_device_uid1"] for r in found}[3] == int(expire is not None)


def test_late_rows_are_set_aside(spark, tmp_path):
    def row(i, t):
        return (i, "u", t, 1.0, 1.0, "a", "m")
    batches = [[row(1, 100), row(2, 200), row(2, 200)], [row(3, 1000), row(4, 150), row(1, 100)],
               [row(5, 900), row(6, 899), row(7, 950), row(3, 1000), row(None, 990), row(None, 990), row(8, None)]]
    path = str(tmp_path / "out")
    stream = arriving(spark, str(tmp_path / "in"), batches)
    found = run_with_late(stream, "late", "TransactionDT", "TransactionID", 100, path)
    assert sorted((r["TransactionID"] or -1, r["TransactionDT"]) for r in found.rows.collect()) == [
        (-1, 990), (-1, 990), (1, 100), (2, 200), (3, 1000), (4, 150), (7, 950)]
    assert sorted((r["TransactionID"], r["TransactionDT"] or -1) for r in found.late.collect()) == [(1, 100), (5, 900), (6, 899), (8, -1)]
    assert [tuple(r) for r in found.counts.orderBy("batch").collect()] == [
        (0, 2, 1, 0, 200, None), (1, 2, 0, 1, 1000, 100), (2, 3, 1, 3, 1000, 900)]
    # Nothing new: the same tables.
    again = run_with_late(stream, "late", "TransactionDT", "TransactionID", 100, path)
    assert again.rows.count() == 7 and again.late.count() == 4
