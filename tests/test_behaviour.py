"""Behaviour features against a brute-force reading of the definitions."""

import math
import random
import statistics
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from riskloom.operators.behaviour import ALL_PARTS, FeatureSpec, amount_ratio, behaviour
from riskloom.operators.columns import user_keys
from riskloom.operators.joins import exists_earlier
from riskloom.plans.features import build_features

SPEC = FeatureSpec(amount_scale=3)
DDL = ("TransactionID bigint, uid1 string, TransactionDT bigint, TransactionAmt double, addr1 double, "
       "DeviceInfo string, DeviceType string")


def random_rows(n, seed, users=4, span=4000, hot=0.4):
    draw = random.Random(seed)
    ids = draw.sample(range(10 * n), n)
    return [(i, "u0" if draw.random() < hot else f"u{draw.randrange(users)}", draw.randrange(0, span, 50),
             None if draw.random() < 0.1 else draw.randrange(1, 100_000) / 1000,
             draw.choice([None, 1.0, 2.0]), draw.choice([None, "a", "b"]), draw.choice([None, "m"])) for i in ids]


def brute(rows):
    """Feature values per id, straight from the definitions."""
    out = {}
    for row in rows:
        i, user, t, amt, addr, info, kind = row
        mine = sorted((r for r in rows if r[1] == user), key=lambda r: (r[2], r[0]))
        at = mine.index(row)
        before, prev = mine[:at], mine[at - 1] if at else None
        past = [r[3] for r in before if r[3] is not None]
        hour = [r[3] for r in mine if t - 3600 <= r[2] <= t and r[3] is not None]
        changes = [b[2] for a, b in zip(mine, mine[1:])
                   if a[4] is not None and b[4] is not None and a[4] != b[4] and b[2] <= t]
        seen = any(r[2] < t and r[5] == info and r[6] == kind for r in mine)
        mean = sum(past) / len(past) if past else None
        out[i] = {
            **{n: sum(t - w <= r[2] <= t for r in mine) for n, w in SPEC.count_widths.items()},
            "time_since_last_tx": t - prev[2] if prev else 0, "amt_1h": sum(hour) if hour else None,
            "cnt_per_uid1": len(before), "avg_amt_per_uid1": mean,
            "std_amt_per_uid1": statistics.stdev(past) if len(past) > 1 else None,
            "amt_vs_avg_ratio": amt / (mean + 1) if mean is not None and amt is not None else None,
            "time_since_last_geo_change": t - max(changes) if changes else None,
            "is_new_device_uid1": 0 if seen else 1}
    return out


def features(spark, rows, spec=SPEC):
    df = amount_ratio(behaviour(spark.createDataFrame(rows, DDL), spec), spec)
    return {r["TransactionID"]: r.asDict() for r in df.collect()}


def same(found, expected):
    if expected is None or found is None:
        return found is expected
    return math.isclose(found, expected, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("spec", [SPEC, replace(SPEC, hot_rows=30, slice_rows=15), replace(SPEC, hot_rows=0, slice_rows=7)],
                         ids=["plain", "some_hot", "all_hot"])
def test_against_brute_force(spark, seed, spec):
    rows = random_rows(150, seed)
    found = features(spark, rows, spec)
    assert len(found) == len(rows)
    for i, expected in brute(rows).items():
        for name, value in expected.items():
            assert same(found[i][name], value), (i, name, found[i][name], value)


def test_one_second_burst_is_sliced(spark):
    """All rows of a user in one second: peers count each other, history goes by id."""
    rows = [(i, "u", 100, 1.0 + i, 1.0, "a", "m") for i in range(60)]
    found = features(spark, rows, replace(SPEC, hot_rows=5, slice_rows=8))
    assert {r["cnt_5m"] for r in found.values()} == {60}
    assert [found[i]["cnt_per_uid1"] for i in range(60)] == list(range(60))
    assert {r["is_new_device_uid1"] for r in found.values()} == {1}


def test_window_edges(spark):
    rows = [(1, "u", 0, 1.0, None, "a", "m"), (2, "u", 300, 2.0, None, "a", "m"), (3, "u", 601, 4.0, None, "a", "m")]
    found = features(spark, rows)
    assert [found[i]["cnt_5m"] for i in (1, 2, 3)] == [1, 2, 1]
    assert [found[i]["cnt_1h"] for i in (1, 2, 3)] == [1, 2, 3]
    assert [found[i]["amt_1h"] for i in (1, 2, 3)] == [1.0, 3.0, 7.0]


def test_first_and_second_row(spark):
    found = features(spark, [(1, "u", 0, 5.0, None, None, None), (2, "u", 9, 7.0, None, None, None)])
    assert found[1]["cnt_per_uid1"] == 0 and found[1]["avg_amt_per_uid1"] is None and found[1]["amt_vs_avg_ratio"] is None
    assert found[2]["avg_amt_per_uid1"] == 5.0 and found[2]["std_amt_per_uid1"] is None


def test_place_through_null_is_no_change(spark):
    rows = [(i, "u", 10 * i, 1.0, place, "a", "m") for i, place in enumerate([1.0, None, 2.0, 2.0, 3.0])]
    found = features(spark, rows)
    assert [found[i]["time_since_last_geo_change"] for i in range(5)] == [None, None, None, None, 0]


def test_later_rows_change_nothing(spark):
    """Cutting the table at a time leaves all features up to it as they were."""
    rows = random_rows(200, 7)
    for spec in (SPEC, replace(SPEC, hot_rows=20, slice_rows=10)):
        full = features(spark, rows, spec)
        cut = features(spark, [r for r in rows if r[2] <= 2000], spec)
        names = [n for n in spec.feature_names(ALL_PARTS)] + ["amt_vs_avg_ratio"]
        assert all(cut[i][n] == full[i][n] for i in cut for n in names)


def test_both_first_sighting_forms_agree(spark):
    df = spark.createDataFrame(random_rows(200, 11), DDL)
    device = ["uid1", "DeviceInfo", "DeviceType"]
    flagged = exists_earlier(behaviour(df, SPEC, ["device"]), df, device, "TransactionDT", "seen")
    assert flagged.where("seen = is_new_device_uid1").count() == 0


def test_sample_record_relations(spark):
    """Values of a known record: ratio, key texts."""
    row = spark.createDataFrame([(30.814, 43.48055555555556)], "TransactionAmt double, avg_amt_per_uid1 double")
    assert amount_ratio(row, SPEC).first()["amt_vs_avg_ratio"] == 0.6927521388871541
    raw = spark.createDataFrame([(5812, 408.0, None, "gmail.com", "SM-A710M")],
                                "card1 bigint, card2 double, addr1 double, P_emaildomain string, DeviceInfo string")
    keys = user_keys(raw, ("uid1", "uid2", "uid3", "uid4")).first()
    assert (keys["uid1"], keys["uid2"]) == ("5812", "5812_408")
    assert (keys["uid3"], keys["uid4"]) == ("5812_408_missing_gmail.com", "5812_408_missing_SM-A710M")


def test_missing_cards_form_one_user(spark):
    raw = spark.createDataFrame([(None, 1.5e7), (None, 1.5), (3, None)], "card1 bigint, card2 double")
    keys = [tuple(r) for r in user_keys(raw, ("uid1", "uid2")).select("uid1", "uid2").collect()]
    assert keys == [("missing", "missing_15000000"), ("missing", "missing_1.5"), ("3", "3_missing")]


def test_feature_table_with_identity(spark):
    tx = spark.createDataFrame([(1, 0, 10, 5.0, 7, 1.0), (2, 1, 20, 6.0, 7, 2.0)],
                               "TransactionID bigint, isFraud bigint, TransactionDT bigint, TransactionAmt double, card1 bigint, addr1 double")
    identity = spark.createDataFrame([(2, 4.0, "ios", "mobile")], "TransactionID bigint, `id-01` double, DeviceInfo string, DeviceType string")
    table = build_features(tx, identity)
    assert table.columns[:6] == ["TransactionID", "TransactionDT", "TransactionAmt", "DeviceInfo", "DeviceType", "uid1"]
    rows = {r["TransactionID"]: r for r in table.collect()}
    assert rows[1]["id_01"] is None and rows[2]["id_01"] == 4.0 and rows[2]["time_since_last_geo_change"] == 0


def test_wide_tables_are_shuffled_once(spark, tmp_path):
    """Same rows with and without carrying; the wide row is exchanged once, by id."""
    rows = [(i, i % 2, 10 * (i % 40), 1.0 + i, i % 5, float(i % 3)) for i in range(80)]
    names = "TransactionID bigint, isFraud bigint, TransactionDT bigint, TransactionAmt double, card1 bigint, addr1 double"
    spark.createDataFrame(rows, names).withColumns({f"V{i}": F.col("TransactionAmt") * i for i in range(1, 60)}).write.parquet(f"{tmp_path}/tx")
    tx = spark.read.parquet(f"{tmp_path}/tx")
    identity = tx.where("TransactionID % 3 = 0").selectExpr("TransactionID", "V2 AS `id-01`", "'ios' AS DeviceInfo", "'mobile' AS DeviceType")
    wide, carried = build_features(tx, identity), build_features(tx, identity, carried=1000)
    assert wide.columns == carried.columns
    assert sorted(map(repr, wide.collect())) == sorted(map(repr, carried.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = build_features(tx, identity)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(uid1") == 1  # the narrow rows
        assert "Exchange hashpartitioning(TransactionID" in plan
        carried = build_features(tx, identity, carried=1000)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Sort [") - carried.count("Sort [") == 3  # narrow sorts instead of wide ones
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_shuffle_and_no_python(spark):
    df = spark.createDataFrame(random_rows(50, 3), DDL)
    plan = behaviour(df, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort ") == 2 and "Python" not in plan


def test_unknown_part(spark):
    with pytest.raises(ValueError):
        behaviour(spark.createDataFrame([], DDL), SPEC, ["speed"])


def test_only_needed_columns_are_read(spark, tmp_path):
    spark.createDataFrame(random_rows(50, 3), DDL).withColumn("V1", F.lit(1.0)).write.parquet(f"{tmp_path}/t")
    wide = spark.read.parquet(f"{tmp_path}/t")
    plan = behaviour(wide, SPEC, ["velocity"]).select("TransactionID", "cnt_5m")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<TransactionID:bigint,uid1:string,TransactionDT:bigint>" in plan


@pytest.mark.parametrize("spec", [SPEC, replace(SPEC, hot_rows=0, slice_rows=2)], ids=["plain", "hot"])
def test_missing_ids_come_last_in_their_second(spark, spec):
    rows = [(None, "u0", 100, 3.0, 1.0, "p"), (7, "u0", 100, 5.0, 2.0, "p"), (9, "u0", 200, 8.0, 2.0, "p"), (2, "u0", 50, 1.0, 1.0, "p")]
    df = spark.createDataFrame(rows, "TransactionID bigint, uid1 string, TransactionDT bigint, TransactionAmt double, addr1 double, DeviceInfo string")
    found = behaviour(df.withColumn("DeviceType", F.lit("d")), spec).select(
        "TransactionID", "cnt_per_uid1", "time_since_last_tx", "avg_amt_per_uid1", "geo_change_dt")
    assert {tuple(r) for r in found.collect()} == {
        (2, 0, 0, None, None), (7, 1, 50, 1.0, 100), (None, 2, 0, 3.0, 100), (9, 3, 100, 3.0, 200)}
