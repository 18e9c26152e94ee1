"""Streams over the events: decisions, features and replay protection at arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.behaviour import COUNTS, AMOUNT, EVENT_DEVICE, GAP, HISTORY, RATIO, SINCE, change, new_device
from riskloom.catalog.decisions import BLOCK, FALLBACK, THRESHOLD, decision_sql
from riskloom.catalog.inputs import SCORED, SPEC, TX, table, transactions_from
from riskloom.catalog.models import PARAMS
from riskloom.catalog.registry import query
from riskloom.functions import epoch_seconds
from riskloom.operators.columns import user_keys
from riskloom.operators.decisions import decide, fallback_fraud, huge_amount_from_new_device
from riskloom.plans.scoring import score_and_decide
from riskloom.plans.training import train
from riskloom.session import scratch_path, written
from riskloom.streaming.behaviour import stream_features
from riskloom.streaming.ordered import STATE_STORE, ordered_features
from riskloom.streaming.runs import drop_replays, read_stream, run_available, run_with_late


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_stream(spark, sf_dir, "events.parquet", table(spark, sf_dir, "events").schema)


def rules():
    """Mobile devices stand for new ones: a stream without state has no first sightings."""
    return [huge_amount_from_new_device(above=BLOCK)]


@query("stream_score", f"""WITH {SCORED}, rows AS (SELECT "TransactionID", "TransactionAmt", "DeviceType", prob FROM tx
  JOIN (SELECT "TransactionID", prob FROM scored) s USING ("TransactionID")) """ + decision_sql(
    f"""("TransactionAmt" > {BLOCK} AND "DeviceType" = 'mobile')"""))
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions_from(event_stream(spark, sf_dir))
    cents = F.round(F.col("TransactionAmt") * 100).cast("bigint")
    rows = tx.withColumns({"prob": (cents % 997 + F.col("isFraud") * 400) / F.lit(1400.0),
                           "is_new_device_uid1": (F.col("DeviceType") == "mobile").cast("bigint")})
    return run_available(decide(rows, THRESHOLD, rules(), fallback=fallback_fraud(above=FALLBACK)), "decisions")


@query("stream_model_score")
def stream_model_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored model applied to the stream."""
    history = transactions_from(table(spark, sf_dir, "events"))
    history = history.drop("DeviceInfo", "P_emaildomain")  # they spell out the label
    trained = train(history, scratch_path(spark, "model"), PARAMS)
    tx = transactions_from(event_stream(spark, sf_dir))
    rows = tx.withColumn("is_new_device_uid1", (F.col("DeviceType") == "mobile").cast("bigint"))
    decided = score_and_decide(rows, trained, rules(), ["TransactionID", "TransactionAmt", "is_new_device_uid1"])
    return run_available(decided, "decisions")


@query("stream_features", f"""WITH {TX}, f AS (SELECT *, {COUNTS}, {AMOUNT}, {HISTORY}, {GAP}, {change('addr1')} FROM tx),
g AS (SELECT *, {RATIO}, {SINCE} FROM f)
SELECT "TransactionID", "TransactionDT", "TransactionAmt", uid1, cnt_5m, cnt_1h, cnt_24h, cnt_7d, time_since_last_tx, amt_1h, cnt_per_uid1,
  avg_amt_per_uid1, std_amt_per_uid1, amt_vs_avg_ratio, time_since_last_geo_change, {new_device(EVENT_DEVICE)} FROM g t""")
def stream_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = user_keys(transactions_from(event_stream(spark, sf_dir)))
    return run_available(stream_features(tx, SPEC), "features")


@query("stream_late", "SELECT event_id, user_id, value FROM events")
def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event arrives twice and counts once."""
    twice = event_stream(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "copy", F.explode(F.array(F.lit(0), F.lit(1))))
    once = drop_replays(twice, "ts", "event_id")
    return run_available(once.select("event_id", "user_id", "value"), "events")


DAY = 86400
# Seconds by which a row may arrive after a later one, and by which the watermark follows the latest row.
DISORDER, DELAY = DAY, 2 * DAY


def shuffled_stream(spark: SparkSession, sf_dir: str, held_back: bool = False) -> DataFrame:
    """The events in four files by arrival, up to a day out of order; ``held_back``: every tenth event comes last of all, twice."""
    events = table(spark, sf_dir, "events")
    arrival = epoch_seconds(F.col("ts")) + F.col("event_id") * 7919 % DISORDER
    rows = written(events.withColumn("_arrival", arrival), "arrivals")
    last = F.col("event_id") % 10 == 0 if held_back else F.lit(False)
    low, high = rows.agg(F.min("_arrival"), F.max("_arrival")).first()
    path = scratch_path(spark, "arriving")
    for i in range(4):
        begin, end = (low + (high - low + 1) * k // 4 for k in (i, i + 1))
        part = rows.where((F.col("_arrival") >= begin) & (F.col("_arrival") < end) & ~last)
        part.drop("_arrival").coalesce(1).write.mode("append").parquet(path)
    if held_back:
        rows.where(last).drop("_arrival").withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy").coalesce(1) \
            .write.mode("append").parquet(path)
    return read_stream(spark, path, "*.parquet", events.schema, files_per_trigger=1)


@query("stream_features_ordered", f"""WITH {TX}, f AS (SELECT *, {COUNTS}, {AMOUNT}, {HISTORY}, {GAP}, {change('addr1')} FROM tx),
g AS (SELECT *, {RATIO}, {SINCE} FROM f)
SELECT "TransactionID", "TransactionDT", "TransactionAmt", uid1, cnt_5m, cnt_1h, cnt_24h, cnt_7d, time_since_last_tx, amt_1h, cnt_per_uid1,
  avg_amt_per_uid1, std_amt_per_uid1, amt_vs_avg_ratio, time_since_last_geo_change, {new_device(EVENT_DEVICE)} FROM g t
WHERE "TransactionDT" <= (SELECT max("TransactionDT") FROM tx) - {DELAY}""")
def stream_features_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive out of order, worked off in time order once the watermark has passed them."""
    name, value = next(iter(STATE_STORE.items()))
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        tx = user_keys(transactions_from(shuffled_stream(spark, sf_dir)))
        return run_available(ordered_features(tx, SPEC, f"{DELAY} seconds"), "ordered_features")
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@query("stream_late_rows", f"""WITH e AS (SELECT event_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS dt, value FROM events),
w AS (SELECT max(dt) - {DELAY} AS mark FROM e WHERE event_id % 10 <> 0)
SELECT event_id, CASE WHEN event_id % 10 = 0 AND dt <= mark THEN 'late' ELSE 'row' END AS kind,
  CAST(CASE WHEN event_id % 10 = 0 AND dt <= mark THEN 2 ELSE 1 END AS BIGINT) AS n FROM e, w""")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth event comes last and twice: behind the watermark it is set aside, above it the replay is dropped."""
    stream = shuffled_stream(spark, sf_dir, held_back=True).withColumn("dt", epoch_seconds(F.col("ts")))
    found = run_with_late(stream, "late_rows", "dt", "event_id", DELAY)
    kinds = found.rows.withColumn("kind", F.lit("row")).unionByName(found.late.withColumn("kind", F.lit("late")))
    return kinds.groupBy("event_id", "kind").agg(F.count(F.lit(1)).alias("n"))
