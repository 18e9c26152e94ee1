"""Sources and sinks, each as a round trip over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.catalog.inputs import SCORED, SPLIT, TX, scored, table, transactions
from riskloom.catalog.registry import query
from riskloom.operators.models import predicted_class
from riskloom.operators.splits import time_split
from riskloom.session import scratch_path
from riskloom.sources import metadata, readers, schema, sinks

TX_COLUMNS = '"TransactionID", "isFraud", "TransactionDT", "TransactionAmt", card1, card2, addr1, "P_emaildomain", "DeviceInfo", "DeviceType"'


def csv_of(df: DataFrame) -> str:
    path = scratch_path(df.sparkSession, "csv")
    df.write.option("header", True).csv(path)
    return path


@query("src_csv", f"WITH {TX} SELECT {TX_COLUMNS} FROM tx")
def src_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions(spark, sf_dir).drop("C1")
    declared = T.StructType([f for f in schema.feature_schema() if f.name in rows.columns])
    ordered = rows.select(*declared.names)
    return readers.read_csv(spark, csv_of(ordered), declared)


CSV_COLUMNS = ("TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "card1", "card2", "addr1", "P_emaildomain",
               "DeviceInfo", "DeviceType", "C1")


@query("src_infer", f"WITH {TX}, kinds AS (" + " UNION ALL ".join(
    f"""(SELECT {i} AS position, '{c}' AS column_name, any_value(typeof("{c}")) AS kind FROM tx)""" for i, c in enumerate(CSV_COLUMNS))
    + """) SELECT position, column_name, CASE kind WHEN 'VARCHAR' THEN 'TEXT' WHEN 'DOUBLE' THEN 'DOUBLE PRECISION' ELSE kind END AS sql_type FROM kinds""")
def src_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types found in the written text are those the rows had."""
    return readers.infer_schema(spark, csv_of(transactions(spark, sf_dir)))


@query("src_table", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def src_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_table(spark, f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_extendedprice")


ORDER_TYPES = (("o_orderkey", "BIGINT"), ("o_custkey", "BIGINT"), ("o_orderstatus", "TEXT"), ("o_totalprice", "DOUBLE PRECISION"),
               ("o_orderdate", "TIMESTAMP"), ("o_orderpriority", "TEXT"))


@query("src_meta", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS sql_type, count({c}) AS n_values FROM orders"
    for i, (c, t) in enumerate(ORDER_TYPES, 1)))
def src_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.column_list(table(spark, sf_dir, "orders"))


@query("sink_parquet", f"""WITH {TX}, {SPLIT.format('tx')} SELECT "TransactionID", "isFraud", "TransactionAmt" FROM split_rows WHERE split = 'val'""")
def sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "splits")
    split = time_split(transactions(spark, sf_dir))
    sinks.write_splits(split.select("TransactionID", "isFraud", "TransactionAmt", "split"), path)
    return sinks.read_split(spark, path, "val")


@query("sink_csv", f"""WITH {SCORED} SELECT "TransactionID", CAST(CASE WHEN prob > 0.4 THEN 1 ELSE 0 END AS INTEGER) AS "isFraud" FROM scored""")
def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "submission")
    rows = scored(spark, sf_dir).select("TransactionID", predicted_class(F.col("prob"), 0.4).alias("isFraud"))
    sinks.write_submission(rows, path)
    return readers.read_csv(spark, path, T.StructType.fromDDL("TransactionID bigint, isFraud int"))


@query("ctas", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus")
def ctas(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    return sinks.save_as(counts, scratch_path(spark, "table"))


@query("src_values", """SELECT v.name, v.rank, count(o_orderkey) AS n FROM (VALUES ('1-URGENT', 1), ('5-LOW', 5), ('9-NONE', 9)) v(name, rank)
  LEFT JOIN orders ON o_orderpriority = v.name GROUP BY v.name, v.rank""")
def src_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per literal row; orders are counted before they meet the literals."""
    names = spark.createDataFrame([("1-URGENT", 1), ("5-LOW", 5), ("9-NONE", 9)], "name string, rank int")
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return names.join(counts, "name", "left").select("name", "rank", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as JSON requests; those of device type 'error' carry a text where the amount belongs."""
    tx = transactions(spark, sf_dir)
    amount = F.when(F.col("DeviceInfo") == "error", F.lit("much")).otherwise(F.col("TransactionAmt").cast("string"))
    return tx.select(F.to_json(F.struct("TransactionID", "TransactionDT", amount.alias("TransactionAmt"), "card1", "card2",
                                        "DeviceInfo", "DeviceType")).alias("body"))


@query("src_record", f"""WITH {TX} SELECT "TransactionID", "TransactionDT", "TransactionAmt", card1, card2, "DeviceInfo", "DeviceType",
  CAST(NULL AS DOUBLE) AS "V339" FROM tx WHERE "DeviceInfo" IS DISTINCT FROM 'error'""")
def src_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = readers.parse_records(requests(spark, sf_dir), schema.request_schema())
    return readers.accepted(parsed).select("TransactionID", "TransactionDT", "TransactionAmt", "card1", "card2",
                                           "DeviceInfo", "DeviceType", "V339")


@query("src_record_rejected", f"""WITH {TX} SELECT "TransactionID", 'TransactionAmt' AS rejected FROM tx WHERE "DeviceInfo" = 'error'""")
def src_record_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = readers.parse_records(requests(spark, sf_dir), schema.request_schema())
    bad = readers.quarantined(parsed)
    return bad.select(F.get_json_object("body", "$.TransactionID").cast("bigint").alias("TransactionID"),
                      F.array_join("rejected", ",").alias("rejected"))


@query("src_props", """SELECT event_id, CAST(regexp_extract(props, '"k": (\\d+)', 1) AS BIGINT) AS k FROM events""")
def src_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "props")
    return readers.accepted(readers.parse_records(rows, T.StructType.fromDDL("k bigint"), "props")).select("event_id", "k")


@query("meta_store", f"""WITH {TX} SELECT 'n_rows' AS name, CAST(count(*) AS VARCHAR) AS value, CAST(1 AS BIGINT) AS version FROM tx
  UNION ALL SELECT 'original_features', '["TransactionAmt", "card2"]', 1
  UNION ALL SELECT 'n_fraud', CAST(CAST(sum("isFraud") AS BIGINT) AS VARCHAR), 2 FROM tx""")
def meta_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "meta")
    n, fraud = transactions(spark, sf_dir).agg(F.count(F.lit(1)), F.sum("isFraud")).first()
    metadata.add_meta(spark, path, {"n_rows": n, "original_features": ["TransactionAmt", "card2"], "n_fraud": None})
    metadata.add_meta(spark, path, {"n_fraud": fraud})
    return metadata.meta_table(spark, path)
