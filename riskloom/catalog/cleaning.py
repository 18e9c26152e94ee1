"""Keys, cleaning, alignment, encoding and scaling."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.inputs import SPLIT, TX, table, transactions
from riskloom.catalog.registry import query
from riskloom.operators import columns, prep
from riskloom.operators.models import mean_square_score
from riskloom.operators.splits import time_split

CARD2 = "coalesce(CAST(CAST(card2 AS BIGINT) AS VARCHAR), 'missing')"
ADDR1 = "coalesce(CAST(CAST(addr1 AS BIGINT) AS VARCHAR), 'missing')"
MAIL = "coalesce(\"P_emaildomain\", 'missing')"
DEVICE = "coalesce(\"DeviceInfo\", 'missing')"
SPLIT_TX = TX + ", " + SPLIT.format("tx")


@query("uid_keys", f"""WITH {TX} SELECT "TransactionID", uid1, uid1 || '_' || {CARD2} AS uid2,
  uid1 || '_' || {CARD2} || '_' || {ADDR1} || '_' || {MAIL} AS uid3,
  uid1 || '_' || {CARD2} || '_' || {ADDR1} || '_' || {DEVICE} AS uid4 FROM tx""")
def uid_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("uid1", "uid2", "uid3", "uid4")
    return columns.user_keys(transactions(spark, sf_dir), names).select("TransactionID", *names)


@query("rename_cols", "SELECT doc_id AS \"TransactionID\", n_chars AS id_01, lang AS id_12 FROM documents")
def rename_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("TransactionID"), F.col("n_chars").alias("id-01"), F.col("lang").alias("id-12"))
    return columns.hyphens_to_underscores(raw)


@query("drop_list", f"""WITH {TX} SELECT "TransactionAmt", card2, addr1, "P_emaildomain", "DeviceInfo", "DeviceType", "C1" FROM tx""")
def drop_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.drop_listed(transactions(spark, sf_dir))


PROFILED = ("doc_id", "lang", "source", "n_chars", "quality", "toxic")


@query("null_profile", "WITH j AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS null_ratio FROM j"
    for c in PROFILED))
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return columns.null_profile(joined, PROFILED)


@query("downcast", f"""WITH {TX} SELECT "TransactionID", CAST("TransactionAmt" AS FLOAT) AS "TransactionAmt",
  CAST(card2 AS FLOAT) AS card2, CAST(addr1 AS FLOAT) AS addr1 FROM tx""")
def downcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.downcast(transactions(spark, sf_dir)).select("TransactionID", "TransactionAmt", "card2", "addr1")


@query("feature_label", f"""WITH {TX} SELECT "TransactionID", "isFraud", "TransactionAmt", card2, addr1, "P_emaildomain",
  "DeviceInfo", "DeviceType", "C1" FROM tx""")
def feature_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.feature_label(transactions(spark, sf_dir))


@query("align_schema", f"""WITH {TX} SELECT "C1", addr1, CAST(0 AS INTEGER) AS "V1", "TransactionAmt", CAST(0 AS INTEGER) AS "V2" FROM tx""")
def align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.align(transactions(spark, sf_dir), ["C1", "addr1", "V1", "TransactionAmt", "V2"])


AMOUNT_TEXT = "CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS {0}) END"


@query("to_numeric", f"""SELECT event_id, TRY_CAST({AMOUNT_TEXT.format('VARCHAR')} AS DOUBLE) AS amount,
  TRY_CAST(event_type AS DOUBLE) AS kind FROM events""")
def to_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "events").select(
        "event_id", F.expr(AMOUNT_TEXT.format("STRING")).alias("amount"), F.col("event_type").alias("kind"))
    return columns.to_numeric(texts, ["amount", "kind"])


@query("to_category", f"""WITH {SPLIT_TX}, levels AS (
  SELECT "DeviceInfo" AS level, row_number() OVER (ORDER BY count(*) DESC, "DeviceInfo") - 1 AS i
  FROM split_rows WHERE split = 'train' AND "DeviceInfo" IS NOT NULL GROUP BY "DeviceInfo")
  SELECT "TransactionID", CAST(coalesce(i, (SELECT count(*) FROM levels)) AS DOUBLE) AS "DeviceInfo_index"
  FROM tx LEFT JOIN levels ON "DeviceInfo" = level""")
def to_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = time_split(transactions(spark, sf_dir))
    model = prep.fit_categories(split.where("split = 'train'"), ["DeviceInfo"])
    return model.transform(split).select("TransactionID", "DeviceInfo_index")


@query("filter_legit", f"""WITH {TX} SELECT "TransactionID", "TransactionAmt" FROM tx WHERE "isFraud" = 0""")
def filter_legit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.legit_rows(transactions(spark, sf_dir)).select("TransactionID", "TransactionAmt")


@query("cardinality", f"WITH {TX} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(DISTINCT "{c}") AS n_distinct, count(DISTINCT "{c}") < 5 AS encoded FROM tx"""
    for c in ("P_emaildomain", "DeviceInfo", "DeviceType")))
def cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.cardinality(transactions(spark, sf_dir), ["P_emaildomain", "DeviceInfo", "DeviceType"], limit=5)


@query("column_diff", """SELECT c AS column_name, n FROM (SELECT 'c_custkey' AS c, count(c_custkey) AS n FROM customer
  UNION ALL SELECT 'c_mktsegment', count(c_mktsegment) FROM customer)""")
def column_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of customer, without prefix, that supplier lacks, and how many values they hold."""
    customer = table(spark, sf_dir, "customer")
    bare = customer.withColumnsRenamed({c: c[2:] for c in customer.columns})
    supplier = table(spark, sf_dir, "supplier")
    other = supplier.withColumnsRenamed({c: c[2:] for c in supplier.columns})
    only = columns.column_difference(bare, other)
    counts = bare.agg(*[F.count(c).alias(f"c_{c}") for c in only])
    return counts.unpivot([], counts.columns, "column_name", "n")


DUMMIES = {"DeviceInfo": ("click", "error", "missing", "purchase", "view"), "DeviceType": ("desktop", "mobile")}


@query("onehot", f"""WITH {SPLIT_TX}, train AS (SELECT * FROM split_rows WHERE split = 'train') SELECT "TransactionID", """ + ", ".join(
    f"""CAST(CASE WHEN coalesce("{c}", 'missing') = '{v}' AND EXISTS (SELECT 1 FROM train WHERE coalesce(train."{c}", 'missing') = '{v}')
    THEN 1 ELSE 0 END AS FLOAT) AS "{c}_{v}" """ for c, values in DUMMIES.items() for v in values) + "FROM split_rows")
def onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = time_split(transactions(spark, sf_dir))
    levels = prep.fit_levels(split.where("split = 'train'"), list(DUMMIES))
    return levels.transform(split, ["TransactionID"])


NUMBERS = ("TransactionAmt", "card2", "addr1", "C1")
LEGIT = f"""{SPLIT_TX}, legit AS (SELECT * FROM split_rows WHERE split = 'train' AND "isFraud" = 0),
  m AS (SELECT {", ".join(f'avg("{c}") AS "m_{c}"' for c in NUMBERS)} FROM legit),
  d AS (SELECT {", ".join(f'sqrt(sum(coalesce("{c}" - "m_{c}", 0) * coalesce("{c}" - "m_{c}", 0)) / count(*)) AS "d_{c}"' for c in NUMBERS)}
        FROM legit, m)"""
Z = {c: f"""(coalesce("{c}", "m_{c}") - "m_{c}") / CASE WHEN "d_{c}" = 0 THEN 1 ELSE "d_{c}" END""" for c in NUMBERS}


@query("impute_mean", f"""WITH {LEGIT} SELECT "TransactionID", """ + ", ".join(
    f'round(coalesce("{c}", "m_{c}"), 8) AS "{c}"' for c in NUMBERS) + " FROM split_rows, m")
def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = time_split(transactions(spark, sf_dir))
    scaling = prep.fit_scaling(split.where("split = 'train'"), NUMBERS)
    return scaling.impute(split).select("TransactionID", *[F.round(c, 8).alias(c) for c in NUMBERS])


@query("zscore", f"""WITH {LEGIT} SELECT "TransactionID", """ + ", ".join(
    f'round({Z[c]}, 8) AS "{c}"' for c in NUMBERS) + " FROM split_rows, m, d")
def zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = time_split(transactions(spark, sf_dir))
    scaling = prep.fit_scaling(split.where("split = 'train'"), NUMBERS)
    return scaling.transform(split, ["TransactionID"]).select("TransactionID", *[F.round(c, 8).alias(c) for c in NUMBERS])


@query("anomaly_rank0", f"""WITH {LEGIT} SELECT "TransactionID",
  round(({" + ".join(f"({z}) * ({z})" for z in Z.values())}) / 4, 8) AS anomaly_score FROM split_rows, m, d""")
def anomaly_rank0(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = time_split(transactions(spark, sf_dir))
    scaling = prep.fit_scaling(split.where("split = 'train'"), NUMBERS)
    z = scaling.transform(split, ["TransactionID"])
    return z.select("TransactionID", F.round(mean_square_score(scaling.names), 8).alias("anomaly_score"))


@query("nn_matrix", f"""WITH {LEGIT}, train AS (SELECT * FROM split_rows WHERE split = 'train') SELECT "TransactionID", """ + ", ".join(
    f"""CAST(CASE WHEN coalesce("{c}", 'missing') = '{v}' THEN 1 ELSE 0 END AS DOUBLE) AS "{c}_{v}" """
    for c, values in DUMMIES.items() for v in values) + ", " + ", ".join(
    f'round({Z[c]}, 8) AS "{c}"' for c in NUMBERS) + " FROM split_rows, m, d")
def nn_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries of the assembled vector under their recorded names."""
    split = time_split(transactions(spark, sf_dir))
    train = split.where("split = 'train'")
    levels, scaling = prep.fit_levels(train, list(DUMMIES)), prep.fit_scaling(train, NUMBERS)
    matrix = prep.numeric_matrix(split, levels, scaling, ["TransactionID"]).withColumn("_v", vector_to_array("features"))
    return matrix.select("TransactionID", *[
        F.round(F.col("_v")[i], 8).alias(name) for i, name in enumerate([*levels.names, *scaling.names])])
