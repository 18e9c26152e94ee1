"""Missing times, labels and amounts, and types a database has names for."""

import pytest
from pyspark.sql import functions as F

from riskloom.functions.numbers import fixed_point
from riskloom.operators.curves import curve_points
from riskloom.operators.splits import time_cuts, time_split
from riskloom.sources.readers import column_list


def test_rows_without_a_time_are_test_rows(spark):
    rows = [(i, i // 3) for i in range(100)] + [(200 + i, None) for i in range(7)]
    df = spark.createDataFrame(rows, "TransactionID bigint, TransactionDT bigint")
    split = {r["TransactionID"]: r["split"] for r in time_split(df).collect()}
    assert all(split[200 + i] == "test" for i in range(7))
    assert [sum(split[i] == s for i in range(100)) for s in ("train", "val", "test")] == [70, 15, 15]
    cuts = time_cuts(df)
    for s in ("train", "val", "test"):
        assert {r[0] for r in df.where(cuts.predicate(s)).collect()} == {i for i, v in split.items() if v == s}


def test_rows_without_a_label_take_no_part(spark):
    rows = [(0.1, 0), (0.5, 1), (0.5, None), (0.7, None), (0.9, 1), (None, 1)]
    points = curve_points(spark.createDataFrame(rows, "prob double, isFraud int")).orderBy("threshold").collect()
    assert [(r["threshold"], r["tp"], r["fp"], r["positives"], r["negatives"]) for r in points] == [
        (0.1, 2, 1, 2, 1), (0.5, 2, 0, 2, 1), (0.9, 1, 0, 2, 1)]


def test_nan_amounts_are_missing(spark):
    df = spark.createDataFrame([(1.25,), (float("nan"),), (None,)], "amount double")
    assert [r[0] for r in df.select(fixed_point(F.col("amount"), 2)).collect()] == [125, None, None]


@pytest.mark.parametrize("kind, name", [
    ("decimal(10,2)", "NUMERIC(10,2)"), ("date", "DATE"), ("float", "REAL"), ("smallint", "SMALLINT"), ("array<int>", "BIGINT[]"),
    ("array<string>", "TEXT[]"), ("struct<a:int>", "JSONB"), ("map<string,int>", "JSONB"), ("string", "TEXT"), ("bigint", "BIGINT")])
def test_type_names(spark, kind, name):
    assert column_list(spark.createDataFrame([], f"c {kind}")).first()["sql_type"] == name
