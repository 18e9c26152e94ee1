"""Behavioural features on events (no ties) and on orders (ties on the date)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.inputs import ORDER_SPEC, ORDER_TX, SPEC, TX, order_transactions, transactions
from riskloom.catalog.registry import query
from riskloom.operators.behaviour import (
    FeatureSpec, amount_ratio, behaviour, first_sighting, history_stats, since_last, since_place_change,
    velocity_counts, velocity_sums)
from riskloom.operators.columns import user_keys
from riskloom.operators.joins import exists_earlier
from riskloom.plans.features import build_features

ID = '"TransactionID"'
DT = '"TransactionDT"'
RANGE = f"(PARTITION BY uid1 ORDER BY {DT} RANGE BETWEEN {{0}} PRECEDING AND CURRENT ROW)"
PRIOR = f"(PARTITION BY uid1 ORDER BY {DT}, {ID} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
COUNTS = ", ".join(f"CAST(count(*) OVER {RANGE.format(w)} AS BIGINT) AS {n}" for n, w in
                   (("cnt_5m", 300), ("cnt_1h", 3600), ("cnt_24h", 86400), ("cnt_7d", 604800)))
AMOUNT = f"CAST(sum(cents) OVER {RANGE.format(3600)} AS DOUBLE) / 100.0 AS amt_1h"
N, S, Q = (f"coalesce({f} OVER {PRIOR}, 0)" for f in ("count(*)", "sum(cents)", "sum(CAST(cents AS HUGEINT) * cents)"))
HISTORY = f"""CAST({N} AS BIGINT) AS cnt_per_uid1,
  CASE WHEN {N} > 0 THEN CAST({S} AS DOUBLE) / {N} / 100.0 END AS avg_amt_per_uid1,
  CASE WHEN {N} > 1 THEN sqrt(CAST({N} * {Q} - {S} * {S} AS DOUBLE) / ({N} * ({N} - 1))) / 100.0 END AS std_amt_per_uid1"""
GAP = f"coalesce({DT} - lag({DT}) OVER (PARTITION BY uid1 ORDER BY {DT}, {ID}), 0) AS time_since_last_tx"


def change(place: str) -> str:
    return (f"CASE WHEN {place} <> lag({place}) OVER (PARTITION BY uid1 ORDER BY {DT}, {ID}) THEN {DT} END AS geo_change_dt")


SINCE = f"{DT} - max(geo_change_dt) OVER (PARTITION BY uid1 ORDER BY {DT}) AS time_since_last_geo_change"


def new_device(device: tuple[str, str]) -> str:
    same = " AND ".join(f"o.{d} IS NOT DISTINCT FROM t.{d}" for d in device)
    return (f"CAST(CASE WHEN EXISTS (SELECT 1 FROM tx o WHERE o.{DT} < t.{DT} AND o.uid1 = t.uid1 AND {same}) "
            f"THEN 0 ELSE 1 END AS BIGINT) AS is_new_device_uid1")


EVENT_DEVICE = ('"DeviceInfo"', '"DeviceType"')
ORDER_DEVICE = ("o_orderstatus", "o_orderpriority")
RATIO = '"TransactionAmt" / (avg_amt_per_uid1 + 1.0) AS amt_vs_avg_ratio'


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_keys(transactions(spark, sf_dir))


@query("vel_count", f"WITH {TX} SELECT {ID}, {COUNTS} FROM tx")
def vel_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return velocity_counts(tx(spark, sf_dir), SPEC).select("TransactionID", *SPEC.count_widths)


@query("vel_count_ties", f"WITH {ORDER_TX} SELECT {ID}, {COUNTS} FROM tx")
def vel_count_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return velocity_counts(order_transactions(spark, sf_dir), ORDER_SPEC).select("TransactionID", *SPEC.count_widths)


@query("vel_sum", f"WITH {TX} SELECT {ID}, {AMOUNT} FROM tx")
def vel_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return velocity_sums(tx(spark, sf_dir), SPEC).select("TransactionID", "amt_1h")


@query("hist_count", f"WITH {TX} SELECT {ID}, CAST({N} AS BIGINT) AS cnt_per_uid1 FROM tx")
def hist_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_stats(tx(spark, sf_dir), SPEC).select("TransactionID", "cnt_per_uid1")


@query("hist_avg", f"WITH {TX}, h AS (SELECT {ID}, {HISTORY} FROM tx) SELECT {ID}, avg_amt_per_uid1 FROM h")
def hist_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_stats(tx(spark, sf_dir), SPEC).select("TransactionID", "avg_amt_per_uid1")


@query("hist_std", f"WITH {TX}, h AS (SELECT {ID}, {HISTORY} FROM tx) SELECT {ID}, std_amt_per_uid1 FROM h")
def hist_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_stats(tx(spark, sf_dir), SPEC).select("TransactionID", "std_amt_per_uid1")


@query("hist_ties", f"WITH {ORDER_TX} SELECT {ID}, {HISTORY}, {GAP} FROM tx")
def hist_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = behaviour(order_transactions(spark, sf_dir), ORDER_SPEC, ["history", "gap"])
    return full.select("TransactionID", *ORDER_SPEC.feature_names(["history", "gap"]))


@query("amt_ratio", f"WITH {TX}, h AS (SELECT {ID}, \"TransactionAmt\", {HISTORY} FROM tx) SELECT {ID}, {RATIO} FROM h")
def amt_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return amount_ratio(history_stats(tx(spark, sf_dir), SPEC), SPEC).select("TransactionID", "amt_vs_avg_ratio")


@query("since_last", f"WITH {TX} SELECT {ID}, {GAP} FROM tx")
def since_last_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return since_last(tx(spark, sf_dir), SPEC).select("TransactionID", "time_since_last_tx")


@query("geo_change", f"WITH {TX} SELECT {ID}, {change('addr1')} FROM tx")
def geo_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return since_place_change(tx(spark, sf_dir), SPEC).select("TransactionID", "geo_change_dt")


@query("since_geo", f"WITH {TX}, g AS (SELECT *, {change('addr1')} FROM tx) SELECT {ID}, {SINCE} FROM g")
def since_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return since_place_change(tx(spark, sf_dir), SPEC).select("TransactionID", "time_since_last_geo_change")


@query("since_geo_ties", f"WITH {ORDER_TX}, g AS (SELECT *, {change('o_orderpriority')} FROM tx) SELECT {ID}, {SINCE} FROM g")
def since_geo_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = since_place_change(order_transactions(spark, sf_dir), ORDER_SPEC)
    return full.select("TransactionID", "time_since_last_geo_change")


@query("new_device", f"WITH {TX} SELECT {ID}, {new_device(EVENT_DEVICE)} FROM tx t")
def new_device_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_sighting(tx(spark, sf_dir), SPEC).select("TransactionID", "is_new_device_uid1")


@query("semi_exists", f"""WITH {TX} SELECT {ID}, CAST(CASE WHEN EXISTS (
  SELECT 1 FROM tx o WHERE o.{DT} < t.{DT} AND o.uid1 = t.uid1 AND o."DeviceInfo" IS NOT DISTINCT FROM t."DeviceInfo"
  AND o."DeviceType" IS NOT DISTINCT FROM t."DeviceType") THEN 1 ELSE 0 END AS BIGINT) AS seen_before FROM tx t""")
def semi_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tx(spark, sf_dir)
    return exists_earlier(rows, rows, ["uid1", "DeviceInfo", "DeviceType"], "TransactionDT", "seen_before").select(
        "TransactionID", "seen_before")


def feature_sql(source: str, place: str, device: tuple[str, str], rest: str) -> str:
    return f"""WITH {source},
f AS (SELECT *, {COUNTS}, {AMOUNT}, {HISTORY}, {GAP}, {change(place)} FROM tx),
g AS (SELECT *, {RATIO}, {SINCE} FROM f)
SELECT {ID}, {DT}, "TransactionAmt", uid1, cnt_5m, cnt_1h, cnt_24h, cnt_7d, time_since_last_tx, amt_1h, cnt_per_uid1,
  avg_amt_per_uid1, std_amt_per_uid1, amt_vs_avg_ratio, time_since_last_geo_change, {new_device(device)}{rest} FROM g t"""


FEATURES_SQL = feature_sql(
    TX, "addr1", EVENT_DEVICE, ', "DeviceInfo", "DeviceType", "isFraud", card1, card2, addr1, "P_emaildomain", "C1"')
ORDER_FEATURES_SQL = feature_sql(ORDER_TX, "o_orderpriority", ORDER_DEVICE, "")


def order_features(spark: SparkSession, sf_dir: str, spec: FeatureSpec) -> DataFrame:
    full = amount_ratio(behaviour(order_transactions(spark, sf_dir), spec), spec)
    return full.drop("geo_change_dt", "o_orderstatus", "o_orderpriority")


@query("feature_table", FEATURES_SQL)
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_features(transactions(spark, sf_dir), spec=SPEC)


SPARSE_TX = TX.replace(
    "CASE WHEN k % 2 = 0 THEN 'mobile' ELSE 'desktop' END", "CASE WHEN event_type <> 'signup' THEN CASE WHEN k % 2 = 0 THEN 'mobile' ELSE 'desktop' END END")


@query("feature_table_identity", feature_sql(
    SPARSE_TX, "addr1", EVENT_DEVICE, """, "DeviceInfo", "DeviceType", "isFraud", card1, card2, addr1, "P_emaildomain",
  CASE WHEN "DeviceInfo" IS NOT NULL THEN "C1" END AS id_01"""))
def feature_table_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices come from a sparse side table; wide rows meet their features on the id."""
    full = transactions(spark, sf_dir)
    identity = full.where("DeviceInfo IS NOT NULL").select("TransactionID", F.col("C1").alias("id-01"), "DeviceInfo", "DeviceType")
    return build_features(full.drop("C1", "DeviceInfo", "DeviceType"), identity, spec=SPEC, carried=0)


@query("feature_table_ties", ORDER_FEATURES_SQL)
def feature_table_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_features(spark, sf_dir, ORDER_SPEC)


@query("feature_table_hot", FEATURES_SQL)
def feature_table_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table with the heavier users cut into slices."""
    return build_features(transactions(spark, sf_dir), spec=replace(SPEC, hot_rows=65, slice_rows=1500))


@query("feature_table_hot_ties", ORDER_FEATURES_SQL)
def feature_table_hot_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_features(spark, sf_dir, replace(ORDER_SPEC, hot_rows=14, slice_rows=1500))


# Rows without an id or a time, and rows that come twice.
NULL_TX = f"""{TX.replace('tx AS (', 'whole AS (', 1)}, tx_all AS (
  SELECT CASE WHEN "TransactionID" % 89 <> 0 THEN "TransactionID" END AS "TransactionID", "isFraud",
    CASE WHEN "TransactionID" % 97 <> 0 THEN "TransactionDT" END AS "TransactionDT", "TransactionAmt", cents, card1, card2, addr1, "P_emaildomain",
    "DeviceInfo", "DeviceType", "C1", uid1 FROM whole, (VALUES (0), (1)) c(copy) WHERE copy = 0 OR "TransactionID" % 83 = 0),
tx AS (SELECT * FROM tx_all WHERE "TransactionDT" IS NOT NULL)"""
REST = ', "DeviceInfo", "DeviceType", "isFraud", card1, card2, addr1, "P_emaildomain", "C1"'
NULL_FEATURES_SQL = feature_sql(NULL_TX, "addr1", EVENT_DEVICE, REST) + f"""
UNION ALL SELECT "TransactionID", "TransactionDT", "TransactionAmt", uid1, {', '.join(['NULL'] * 12)}{REST} FROM tx_all WHERE "TransactionDT" IS NULL"""


def null_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.col("TransactionID")
    copies = F.when(row % 83 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return transactions(spark, sf_dir).withColumn("_copy", F.explode(copies)).drop("_copy").withColumns({
        "TransactionDT": F.when(row % 97 != 0, F.col("TransactionDT")), "TransactionID": F.when(row % 89 != 0, row)})


@query("feature_table_nulls", NULL_FEATURES_SQL)
def feature_table_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing ids and times and repeated rows, carried through the windows."""
    return build_features(null_transactions(spark, sf_dir), spec=SPEC)


@query("feature_table_nulls_hot", NULL_FEATURES_SQL)
def feature_table_nulls_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the heavier users cut into slices."""
    return build_features(null_transactions(spark, sf_dir), spec=replace(SPEC, hot_rows=65, slice_rows=1500))


@query("feature_table_nulls_wide", NULL_FEATURES_SQL)
def feature_table_nulls_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with wide rows that meet their features afterwards."""
    return build_features(null_transactions(spark, sf_dir), spec=SPEC, carried=0)
