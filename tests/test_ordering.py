import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators.ordering import (
    MANY_SLICES, SLICE_ROWS, Running, hot_keys, keys_at, order_slices, plain_running, running, slice_count, sliced_running,
    value_slices)
from riskloom.operators.ranking import rank_within, top_within
from riskloom.operators.splits import split_sizes, stratified_folds, time_cuts, time_split
from riskloom.session import scratch_path, shared_dir


def table(spark, n=300, seed=1):
    draw = random.Random(seed)
    rows = [(None if draw.random() < 0.2 else draw.choice("aab"), draw.randrange(40), i, draw.choice([None, *range(9)])) for i in range(n)]
    return spark.createDataFrame(rows, "k string, t bigint, id bigint, v bigint")


ITEMS = lambda: [  # noqa: E731 - expressions need a running session
    Running("s", "sum", F.col("v")), Running("s0", "sum", F.col("v"), False), Running("lo", "min", F.col("v")),
    Running("hi", "max", F.col("v"), False), Running("prev", "last", F.struct("t", "v"), False),
    Running("all", "sum", F.col("v"), whole=True)]


def as_rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("slice_rows", [7, 50, 1000])
def test_sliced_equals_plain(spark, slice_rows):
    df = table(spark)
    plain = plain_running(df, ["k"], ["t", "id"], ITEMS())
    cut = order_slices(df, ["k", "t", "id"], 300, slice_rows=slice_rows)
    sliced = sliced_running(cut, ["k"], "_slice", ["t", "id"], ITEMS(), last_by=["t", "id"]).drop("_slice")
    assert as_rows(sliced) == as_rows(plain)


def test_running_mixes_hot_and_cold(spark):
    df = table(spark)
    assert as_rows(running(df, ["k"], ["t", "id"], ITEMS(), hot_rows=70, slice_rows=20)) == as_rows(
        plain_running(df, ["k"], ["t", "id"], ITEMS()))


def test_hot_keys_include_null(spark):
    df = spark.createDataFrame([(None,)] * 9 + [("a",)] * 3, "k string")
    hot = hot_keys(df, ["k"], 5)
    assert hot.rows == 9 and hot.keys.collect()[0]["k"] is None
    assert hot_keys(df, ["k"], 9) is None


def test_value_slices_ascend(spark):
    df = spark.createDataFrame([(float(i % 37),) for i in range(500)], "x double")
    per_slice = value_slices(df, "x", slices=6).groupBy("_slice").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("_slice").collect()
    assert len(per_slice) > 3
    assert all(a["hi"] < b["lo"] for a, b in zip(per_slice, per_slice[1:]))


@pytest.mark.parametrize("cells", [16, 4096])
def test_keys_at(spark, cells):
    draw = random.Random(3)
    rows = [(draw.choice([-5, 0, 7, draw.randrange(-1000, 100_000)]), i) for i in draw.sample(range(-500, 10_000), 200)]
    df = spark.createDataFrame(rows, "t bigint, id bigint")
    positions = [0, 17, 100, 199]
    low, high = min(t for t, _ in rows), max(t for t, _ in rows)
    assert keys_at(df, ["t", "id"], positions, low, high, cells) == [sorted(rows)[p] for p in positions]


@pytest.mark.parametrize("kind", ["row_number", "rank", "dense_rank"])
def test_ranks_of_heavy_groups(spark, kind):
    df = table(spark).where("v IS NOT NULL")
    plain = rank_within(df, ["k"], "v", "id", kind, "r")
    assert as_rows(rank_within(df, ["k"], "v", "id", kind, "r", hot_rows=50, slice_rows=9)) == as_rows(plain)


def test_top_rows_are_limited_before_the_shuffle(spark):
    top = top_within(table(spark), ["k"], "v", "id", 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("n,tied", [(101, False), (100, True), (10, False), (3, False)])
def test_time_split(spark, n, tied):
    draw = random.Random(n)
    rows = [(i, 5 if tied and i % 3 else draw.randrange(1000)) for i in draw.sample(range(1000), n)]
    split = time_split(spark.createDataFrame(rows, "TransactionID bigint, TransactionDT bigint"))
    found = {r["TransactionID"]: r["split"] for r in split.collect()}
    ordered = [i for i, _ in sorted(rows, key=lambda r: (r[1], r[0]))]
    val, test = int(n * 0.7), n - int(n * 0.15)
    expected = {i: "train" if p < val else "val" if p < test else "test" for p, i in enumerate(ordered)}
    assert found == expected


def test_time_cuts_reach_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id AS TransactionID", "id * 10 AS TransactionDT").write.parquet(f"{tmp_path}/t")
    rows = spark.read.parquet(f"{tmp_path}/t")
    cuts = time_cuts(rows)
    sizes = {}
    for split in ("train", "val", "test"):
        part = rows.where(cuts.predicate(split))
        plan = part._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters"):]
        assert "Than" in pushed and "TransactionDT" in pushed
        sizes[split] = part.count()
    assert sizes == {"train": 70, "val": 15, "test": 15}


@pytest.mark.parametrize("sizes", [(0, 0.2), (0.7, 0), (0.8, 0.2), (-1, 0.5)])
def test_split_sizes_are_checked(sizes):
    with pytest.raises(ValueError):
        split_sizes(10, *sizes)


def test_empty_split():
    with pytest.raises(ValueError):
        split_sizes(0)


def test_folds_are_even_per_label(spark):
    rows = [(i, 1 if i % 9 == 0 else 0) for i in range(503)]
    df = spark.createDataFrame(rows, "TransactionID bigint, isFraud bigint")
    folds = stratified_folds(df, 5)
    for label in (0, 1):
        sizes = [r["count"] for r in folds.where(F.col("isFraud") == label).groupBy("fold").count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    sizes = [r["count"] for r in folds.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 1
    assert as_rows(folds) == as_rows(stratified_folds(df.repartition(3), 5))
    assert as_rows(folds) != as_rows(stratified_folds(df, 5, seed=7))


def test_shared_folder_is_kept(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_small_slices_do_not_multiply_with_the_rows(spark):
    df = spark.range(3 * MANY_SLICES).withColumn("t", F.col("id"))
    cut = order_slices(df, ["t", "id"], 3 * MANY_SLICES, slice_rows=1)
    assert len(cut.inputFiles()) <= MANY_SLICES
    assert slice_count(54_000_000, 1000) == MANY_SLICES and slice_count(300, 7) == 43
    assert slice_count(1000 * MANY_SLICES * SLICE_ROWS, 1000) == 1000 * MANY_SLICES
