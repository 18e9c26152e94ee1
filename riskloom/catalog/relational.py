"""General relational queries: projections, filters, joins, groups, ranks, sorts, unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.behaviour import COUNTS
from riskloom.catalog.inputs import SCORED, SPEC, TX, scored, table, transactions
from riskloom.catalog.registry import query
from riskloom.functions import ascending, descending, exact_mean, fixed_point
from riskloom.operators.behaviour import velocity_counts
from riskloom.operators.columns import case_label, user_keys
from riskloom.operators.joins import assemble, attach_scores, join_identity, update_from
from riskloom.operators.ranking import group_mean_per_row, rank_within, top_within
from riskloom.session import parallelism, scratch_path
from riskloom.sources.sinks import save_bucketed

CENTS = "CAST(round({0} * 100) AS BIGINT)"


def mean_sql(column: str) -> str:
    cents = CENTS.format(column)
    return f"CAST(sum({cents}) AS DOUBLE) / count({column}) / 100.0"


def mean_of(column: str):
    units = fixed_point(F.col(column), 2)
    return exact_mean(F.sum(units), F.count(units), 2)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


@query("project", f"SELECT {ORDER_COLUMNS} FROM orders")
def project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).select(*ORDER_COLUMNS.split(", "))


@query("filter_where", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000 AND o_orderstatus = 'F'")
def filter_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).where("o_totalprice > 250000 AND o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")


@query("filter_where_or", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 50000 OR o_orderpriority = '1-URGENT'")
def filter_where_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).where("o_totalprice < 50000 OR o_orderpriority = '1-URGENT'").select("o_orderkey", "o_totalprice")


@query("case_when", """SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'large' WHEN o_totalprice > 100000 THEN 'middle' END AS size FROM orders""")
def case_when(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    return orders(spark, sf_dir).select("o_orderkey", case_label([(price > 400000, "large"), (price > 100000, "middle")]).alias("size"))


@query("nullsafe_eq", f"""WITH {TX} SELECT "TransactionID", ("DeviceInfo" || '.com') IS NOT DISTINCT FROM "P_emaildomain" AS same,
  ("DeviceInfo" || '.com') = "P_emaildomain" AS equal FROM tx""")
def nullsafe_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = F.concat("DeviceInfo", F.lit(".com"))
    return transactions(spark, sf_dir).select(
        "TransactionID", mail.eqNullSafe(F.col("P_emaildomain")).alias("same"), (mail == F.col("P_emaildomain")).alias("equal"))


@query("join_identity", "SELECT doc_id, lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)")
def join_identity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return join_identity(documents, table(spark, sf_dir, "labels"), "doc_id")


ASSEMBLED = f"""WITH {TX}, f AS (SELECT "TransactionID", {COUNTS} FROM tx)
  SELECT f.*, "TransactionAmt", "isFraud", addr1, "DeviceInfo" FROM f LEFT JOIN tx USING ("TransactionID")"""
RAW = ["TransactionID", "TransactionAmt", "isFraud", "addr1", "DeviceInfo"]


@query("join_assemble", ASSEMBLED)
def join_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = transactions(spark, sf_dir).select(*RAW)
    features = velocity_counts(user_keys(transactions(spark, sf_dir)), SPEC).select("TransactionID", *SPEC.count_widths)
    return assemble(features, raw)


def bucketed(rows: DataFrame, name: str) -> DataFrame:
    """A table of its own, dealt by the id into as many buckets as the session shuffles to."""
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    return save_bucketed(rows, path.rsplit("/", 1)[1].replace("-", "_"), path, "TransactionID", parallelism(spark))


@query("join_assemble_bucketed", ASSEMBLED)
def join_assemble_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features and raw columns from tables stored by id: neither the check for repeated ids nor the join shuffles."""
    raw = bucketed(transactions(spark, sf_dir).select(*RAW), "raw_columns")
    counts = velocity_counts(user_keys(transactions(spark, sf_dir)), SPEC).select("TransactionID", *SPEC.count_widths)
    return assemble(bucketed(counts, "count_features"), raw)


@query("join_update", """SELECT d.doc_id, d.lang, CASE WHEN l.doc_id IS NOT NULL THEN CAST(l.quality AS BIGINT) ELSE d.n_chars END AS n_chars
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def join_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    source = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("bigint").alias("n_chars"))
    return update_from(target, source, "doc_id", ["n_chars"])


@query("join_inner", "SELECT c_name, o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    joined = orders(spark, sf_dir).join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("c_name", "o_orderkey", "o_totalprice")


@query("join_agg_sort", f"""SELECT c_name, {mean_sql('o_totalprice')} AS avg_price FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY c_name ORDER BY avg_price DESC""")
def join_agg_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    joined = orders(spark, sf_dir).join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_name").agg(mean_of("o_totalprice").alias("avg_price")).orderBy(descending("avg_price"), "c_name")


@query("attach_scores", f"""WITH {SCORED} SELECT tx."TransactionID", "TransactionAmt", prob AS anomaly_score
  FROM tx LEFT JOIN scored USING ("TransactionID")""")
def attach_scores_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = scored(spark, sf_dir).select("TransactionID", F.col("prob").alias("anomaly_score"))
    return attach_scores(transactions(spark, sf_dir).select("TransactionID", "TransactionAmt"), scores)


@query("agg_group_avg", f"SELECT o_orderpriority, {mean_sql('o_totalprice')} AS avg_price FROM orders GROUP BY o_orderpriority")
def agg_group_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).groupBy("o_orderpriority").agg(mean_of("o_totalprice").alias("avg_price"))


@query("agg_group_keys", "SELECT l_suppkey, l_returnflag FROM lineitem GROUP BY l_suppkey, l_returnflag")
def agg_group_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").count().drop("count")


@query("agg_distinct", "SELECT DISTINCT l_partkey, l_linestatus FROM lineitem")
def agg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_linestatus").distinct()


@query("agg_having", f"""SELECT o_custkey, {mean_sql('o_totalprice')} AS avg_price FROM orders GROUP BY o_custkey
  HAVING {mean_sql('o_totalprice')} > 250000""")
def agg_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = orders(spark, sf_dir).groupBy("o_custkey").agg(mean_of("o_totalprice").alias("avg_price"))
    return means.where("avg_price > 250000")


@query("agg_having_count", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12")
def agg_having_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).where("n > 12")


@query("agg_where_having", f"""SELECT l_suppkey, {mean_sql('l_extendedprice')} AS avg_price FROM lineitem WHERE l_quantity > 25
  GROUP BY l_suppkey HAVING {mean_sql('l_extendedprice')} > 50000""")
def agg_where_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").where("l_quantity > 25")
    return rows.groupBy("l_suppkey").agg(mean_of("l_extendedprice").alias("avg_price")).where("avg_price > 50000")


@query("agg_order", f"""SELECT l_returnflag, l_linestatus, {mean_sql('l_extendedprice')} AS avg_price FROM lineitem
  GROUP BY l_returnflag, l_linestatus ORDER BY avg_price""")
def agg_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus")
    return groups.agg(mean_of("l_extendedprice").alias("avg_price")).orderBy(ascending("avg_price"))


@query("string_agg", """SELECT o_orderpriority, string_agg(o_orderstatus, ', ' ORDER BY o_orderstatus) AS statuses
  FROM (SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders) d GROUP BY o_orderpriority""")
def string_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values first, so that a text is as long as the domain, not as the group."""
    distinct = orders(spark, sf_dir).select("o_orderpriority", "o_orderstatus").distinct()
    return distinct.groupBy("o_orderpriority").agg(
        F.expr("listagg(o_orderstatus, ', ') WITHIN GROUP (ORDER BY o_orderstatus)").alias("statuses"))


@query("win_avg", f"""SELECT o_orderkey, o_custkey, CAST(sum({CENTS.format('o_totalprice')}) OVER (PARTITION BY o_custkey) AS DOUBLE)
  / count(*) OVER (PARTITION BY o_custkey) / 100.0 AS avg_price FROM orders""")
def win_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice")
    return group_mean_per_row(rows, ["o_custkey"], "o_totalprice", "avg_price").drop("o_totalprice")


def rank_sql(function: str, name: str, order: str = "l_quantity DESC") -> str:
    return f"""SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, CAST({function}() OVER (PARTITION BY l_suppkey ORDER BY {order}) AS BIGINT) AS {name} FROM lineitem"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")


def order_ranks(spark: SparkSession, sf_dir: str, kind: str, name: str, **limits: int) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", "o_orderpriority", "o_totalprice")
    return rank_within(rows, ["o_orderpriority"], "o_totalprice", "o_orderkey", kind, name, **limits)


ROWNUM_SQL = """SELECT o_orderkey, o_orderpriority, o_totalprice,
  row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders"""


@query("win_rownum", ROWNUM_SQL)
def win_rownum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_ranks(spark, sf_dir, "row_number", "rn")


@query("win_rownum_hot", ROWNUM_SQL)
def win_rownum_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every priority holds far more rows than a slice."""
    return order_ranks(spark, sf_dir, "row_number", "rn", hot_rows=100, slice_rows=1000)


@query("win_topn", f"SELECT * FROM ({ROWNUM_SQL}) r WHERE rn <= 3")
def win_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", "o_orderpriority", "o_totalprice")
    return top_within(rows, ["o_orderpriority"], "o_totalprice", "o_orderkey", 3)


@query("win_top1", f"SELECT * FROM ({ROWNUM_SQL}) r WHERE rn = 1")
def win_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", "o_orderpriority", "o_totalprice")
    return top_within(rows, ["o_orderpriority"], "o_totalprice", "o_orderkey", 1)


@query("win_rank", rank_sql("rank", "rnk"))
def win_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_within(lines(spark, sf_dir), ["l_suppkey"], "l_quantity", "l_orderkey", "rank", "rnk")


@query("win_rank_hot", rank_sql("rank", "rnk"))
def win_rank_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_within(lines(spark, sf_dir), ["l_suppkey"], "l_quantity", "l_orderkey", "rank", "rnk", hot_rows=590, slice_rows=2000)


@query("win_dense", rank_sql("dense_rank", "drnk"))
def win_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_within(lines(spark, sf_dir), ["l_suppkey"], "l_quantity", "l_orderkey", "dense_rank", "drnk")


@query("win_dense_hot", rank_sql("dense_rank", "drnk"))
def win_dense_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_within(lines(spark, sf_dir), ["l_suppkey"], "l_quantity", "l_orderkey", "dense_rank", "drnk", hot_rows=590, slice_rows=2000)


@query("sort_one", f"SELECT {ORDER_COLUMNS} FROM orders ORDER BY o_totalprice DESC")
def sort_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).select(*ORDER_COLUMNS.split(", ")).orderBy(descending("o_totalprice"))


@query("sort_multi", f"SELECT {ORDER_COLUMNS} FROM orders ORDER BY o_orderpriority DESC, o_totalprice ASC")
def sort_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select(*ORDER_COLUMNS.split(", "))
    return rows.orderBy(descending("o_orderpriority"), ascending("o_totalprice"))


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3")
def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).select("o_orderkey", "o_totalprice").orderBy(descending("o_totalprice"), "o_orderkey").limit(3)


@query("time_sort", f"""WITH {TX} SELECT "TransactionID", "TransactionDT" FROM tx ORDER BY "TransactionDT", "TransactionID" """)
def time_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).select("TransactionID", "TransactionDT").orderBy("TransactionDT", "TransactionID")


@query("union_all", """SELECT c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier
  UNION ALL SELECT s_name, s_acctbal FROM supplier""")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return customer.unionByName(supplier).unionByName(supplier)
