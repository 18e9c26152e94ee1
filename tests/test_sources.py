import json

import pytest
from pyspark.sql import functions as F

from riskloom import session
from riskloom.operators import joins
from riskloom.operators.decisions import decide, fallback_fraud, huge_amount_from_new_device
from riskloom.sources import metadata, readers, schema, sinks


def test_schemas():
    assert len(schema.transaction_schema().fields) == 394 and len(schema.transaction_schema(False).fields) == 393
    assert len(schema.identity_schema().fields) == 41 and "id-01" in schema.identity_schema(True).names
    assert len(schema.feature_schema().fields) == 447
    assert len(schema.feature_schema(False, ("uid1", "uid2", "uid3", "uid4")).fields) == 449
    assert len(schema.request_schema().fields) == 450


def write(tmp_path, text):
    path = tmp_path / "t.csv"
    path.write_text(text)
    return str(path)


def test_csv_nulls_and_quotes(spark, tmp_path):
    path = write(tmp_path, 'TransactionID,a,b\n1,,""\n2,"x ""y"", z",w\n')
    rows = [tuple(r) for r in readers.read_csv(spark, path, "TransactionID bigint, a string, b string").collect()]
    assert rows == [(1, None, ""), (2, 'x "y", z', "w")]


def test_csv_wrong_type_fails(spark, tmp_path):
    path = write(tmp_path, "TransactionID,a\nx,1\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        readers.read_csv(spark, path, "TransactionID bigint, a string").collect()


def test_inferred_types(spark, tmp_path):
    path = write(tmp_path, "i,gap,d,t,b,bgap,none\n1,1,1.5,x,true,true,\n2,,2,3,False,,\n")
    found = {r["column_name"]: r["sql_type"] for r in readers.infer_schema(spark, path).collect()}
    assert found == {"i": "BIGINT", "gap": "DOUBLE PRECISION", "d": "DOUBLE PRECISION", "t": "TEXT", "b": "BOOLEAN",
                     "bgap": "TEXT", "none": "DOUBLE PRECISION"}


def test_records(spark):
    bodies = [json.dumps(b) for b in (
        {"TransactionID": 1, "TransactionAmt": 30.814, "card2": "408", "DeviceInfo": "x", "extra": 1},
        {"TransactionID": 2, "TransactionAmt": "much", "cnt_5m": 1.5},
        {"TransactionID": 3.0, "addr1": None}, {})] + ["not json"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    parsed = readers.parse_records(df, schema.request_schema())
    good = {r["TransactionID"]: r for r in readers.accepted(parsed).select("TransactionID", "TransactionAmt", "card2", "addr1", "DeviceInfo").collect()}
    assert set(good) == {1, 3, None} and good[1]["card2"] == 408.0 and good[1]["TransactionAmt"] == 30.814
    bad = [sorted(r["rejected"]) for r in readers.quarantined(parsed).collect()]
    assert sorted(bad) == [["TransactionAmt", "cnt_5m"], ["body"]]


def test_metadata(spark, tmp_path):
    path = str(tmp_path / "meta")
    assert metadata.read_meta(spark, path) == {}
    metadata.add_meta(spark, path, {"features": ["a", "b"], "best_threshold": 0.1})
    metadata.add_meta(spark, path, {"best_threshold": 0.25, "run_id": "r1"})
    assert metadata.read_meta(spark, path) == {"features": ["a", "b"], "best_threshold": 0.25, "run_id": "r1"}


def test_split_folders(spark, tmp_path):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 7, "train").otherwise("val"))
    sinks.write_splits(df, str(tmp_path / "s"))
    val = sinks.read_split(spark, str(tmp_path / "s"), "val")
    assert sorted(r["id"] for r in val.collect()) == [7, 8, 9]
    assert "PartitionFilters: [isnotnull(split" in val._jdf.queryExecution().executedPlan().toString()


def test_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_update_and_assemble(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    source = spark.createDataFrame([(1, None), (2, "new")], "id int, v string")
    found = {r["id"]: r["v"] for r in joins.update_from(target, source, "id", ["v"]).collect()}
    assert found == {1: None, 2: "new", 3: "c"}
    with pytest.raises(ValueError):
        joins.assemble(target, source.unionAll(source), "id")


def test_decision_branches(spark):
    rows = [(1, 600_000.0, 1, 0.1), (2, 600_000.0, 0, 0.125), (3, 600_000.0, None, 0.3), (4, 20.0, 1, 0.1),
            (5, 10_000_001.0, 0, None), (6, 10_000_000.0, 0, None), (7, None, 1, None)]
    df = spark.createDataFrame(rows, "TransactionID int, TransactionAmt double, is_new_device_uid1 int, prob double")
    found = {r["TransactionID"]: tuple(r)[1:] for r in decide(df, 0.1, [huge_amount_from_new_device()]).collect()}
    assert found[1] == (None, True, "Fraud (Blocked by Business Rules: Blocked by Business Rule: Huge amount from new device)")
    assert found[2] == (0.125, True, "Fraud (Blocked by ML, confidence: 0.12)")  # half to even, as in the texts to match
    assert found[3] == (0.3, True, "Fraud (Blocked by ML, confidence: 0.30)")
    assert found[4] == (0.1, False, "Legit (Passed ML)")  # equal to the threshold is legit
    assert found[5] == (None, True, "Fraud (Blocked by Fallback rules)")
    assert found[6] == found[7] == (None, False, "Legit (Passed Fallback rules)")
    assert df.where(fallback_fraud()).count() == 1


def test_two_writers_of_metadata(spark, tmp_path, monkeypatch):
    """A second writer commits between the first one's look at the versions and its own commit."""
    path = str(tmp_path / "meta")
    metadata.add_meta(spark, path, {"a": 1})
    look, other = metadata._versions, []

    def stale(*args):
        found = look(*args)
        if not other:
            other.append(1)
            other.append(metadata.add_meta(spark, path, {"b": 2, "a": 5}))
        return found

    monkeypatch.setattr(metadata, "_versions", stale)
    assert metadata.add_meta(spark, path, {"a": 3}) == 3 and other[1] == 2
    assert metadata.read_meta(spark, path) == {"a": 3, "b": 2}
    assert sorted(tuple(r) for r in metadata.meta_table(spark, path).collect()) == [("a", "3", 3), ("b", "2", 2)]


def test_records_are_parsed_once(spark):
    df = spark.createDataFrame([('{"TransactionID": 1}',)], "body string")
    plan = readers.parse_records(df, schema.request_schema())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_bucketed_tables_join_without_a_shuffle(spark, sf_dir, tmp_path):
    from riskloom.catalog import relational
    from riskloom.operators.joins import assemble
    from riskloom.sources.sinks import save_bucketed
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = relational.join_assemble_bucketed(spark, sf_dir)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        plain = relational.join_assemble(spark, sf_dir)
        assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
        assert rows.columns == plain.columns and rows.exceptAll(plain).isEmpty() and rows.count() == plain.count()

        # The check for repeated ids is one scan, too; rows without an id are kept and meet nothing.
        keyed = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "TransactionID bigint, x string")
        raw = save_bucketed(keyed, "raw_of_test", f"{tmp_path}/raw", "TransactionID", 3)
        counts = raw.groupBy("TransactionID").count()
        assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
        left = save_bucketed(keyed.withColumnRenamed("x", "f"), "left_of_test", f"{tmp_path}/left", "TransactionID", 3)
        assert sorted(map(tuple, assemble(left, raw).collect()), key=str) == [(1, "a", "a"), (2, "b", "b"), (None, "c", None)]
        with pytest.raises(Exception, match="raw_of_test"):
            save_bucketed(keyed, "raw_of_test", f"{tmp_path}/other", "TransactionID", 3)
        assert raw.count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
