import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import columns, prep
from riskloom.operators.models import mean_square_score


def train_frame(spark):
    rows = [(1, 0, 1.0, None, 3.0, None, "a", "x.y"), (2, 0, 2.0, 5.0, 3.0, None, None, "x_y"),
            (3, 0, None, 6.0, 3.0, None, "b", "z"), (4, 1, 100.0, 90.0, 50.0, 7.0, "c", "z")]
    return spark.createDataFrame(rows, "id bigint, isFraud int, a double, b double, c double, d double, t string, u string")


def test_scaling_is_fitted_on_legit_rows(spark):
    df = train_frame(spark)
    scaling = prep.fit_scaling(df, ["a", "b", "c", "d"])
    assert scaling.dropped == ("d",)  # no legit value to average
    assert scaling.means == {"a": 1.5, "b": 5.5, "c": 3.0}
    imputed = np.array([1.0, 2.0, 1.5])
    assert scaling.deviations["a"] == pytest.approx(imputed.std())
    assert scaling.deviations["c"] == 1.0  # no spread
    z = {r["id"]: r for r in scaling.transform(df, ["id"]).collect()}
    assert z[3]["a"] == 0.0 and z[4]["a"] == pytest.approx((100 - 1.5) / imputed.std()) and z[4]["c"] == 47.0


def test_levels(spark):
    df = train_frame(spark)
    levels = prep.fit_levels(df, ["t", "u"], limit=4)
    assert levels.levels == {"t": ("a", "b", "c", "missing"), "u": ("x.y", "x_y", "z")}
    assert levels.names == ["t_a", "t_b", "t_c", "t_missing", "u_x_y", "u_x_y_5", "u_z"]
    other = spark.createDataFrame([(9, "new", "z"), (10, None, "z")], "id bigint, t string, u string")
    rows = {r["id"]: r for r in levels.transform(other, ["id"]).collect()}
    assert [rows[9][n] for n in levels.names] == [0, 0, 0, 0, 0, 0, 1]
    assert [rows[10][n] for n in levels.names] == [0, 0, 0, 1, 0, 0, 1]
    assert prep.fit_levels(df, ["t", "u"], limit=3) == prep.LevelEncoding({}, ("t", "u"))


def test_matrix(spark):
    df = train_frame(spark)
    levels, scaling = prep.fit_levels(df, ["t"]), prep.fit_scaling(df, ["a", "b"])
    row = prep.numeric_matrix(df, levels, scaling, ["id"]).where("id = 1").first()
    assert list(row["features"].toArray())[:4] == [1.0, 0.0, 0.0, 0.0] and len(row["features"]) == 6


def test_categories(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "t string")
    model = prep.fit_categories(df, ["t"])
    assert list(model.labels) == ["c", "a", "b"]
    found = [r["t_index"] for r in model.transform(spark.createDataFrame([("c",), ("z",), (None,)], "t string")).collect()]
    assert found == [0.0, 3.0, 3.0]


def test_cleaning(spark):
    df = train_frame(spark)
    profile = [tuple(r) for r in columns.null_profile(df, ["a", "d", "c"]).collect()]
    assert profile == [("d", 0.75), ("a", 0.25), ("c", 0.0)]
    assert columns.drop_sparse(df, 0.5).columns == ["id", "isFraud", "a", "b", "c", "t", "u"]
    assert columns.align(df, ["c", "zzz", "a"]).first().asDict() == {"c": 3.0, "zzz": 0, "a": 1.0}
    assert columns.align(df, ["d"]).first()["d"] is None  # a NULL stays missing
    assert dict(columns.downcast(df).dtypes)["a"] == "float"
    assert columns.drop_listed(df.withColumn("uid1", F.lit("x"))).columns == ["id", "a", "b", "c", "d", "t", "u"]
    renamed = columns.hyphens_to_underscores(spark.createDataFrame([(1, 2)], "`id-01` int, x int"))
    assert renamed.columns == ["id_01", "x"]
    numbers = columns.to_numeric(spark.createDataFrame([("1.5",), ("x",), (None,)], "t string"), ["t"])
    assert [r["t"] for r in numbers.collect()] == [1.5, None, None]


def test_mean_square_score(spark):
    row = spark.createDataFrame([(3.0, 1.0)], "a double, b double").select(mean_square_score(["a", "b"]).alias("s")).first()
    assert row["s"] == 5.0
