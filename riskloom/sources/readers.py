"""Batch readers: CSV, tables, JDBC, request records, and descriptions of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import whole_number

# SQL type per inferred type; anything else is TEXT.
SQL_TYPES = {"tinyint": "SMALLINT", "smallint": "SMALLINT", "int": "BIGINT", "bigint": "BIGINT", "float": "REAL",
             "double": "DOUBLE PRECISION", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP",
             "timestamp_ntz": "TIMESTAMP", "binary": "BYTEA", "variant": "JSONB"}


def sql_type(kind: T.DataType) -> str:
    """Column type of a database for a Spark type: arrays of simple types as such, other nested types as JSON."""
    if isinstance(kind, T.DecimalType):
        return f"NUMERIC({kind.precision},{kind.scale})"
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.ArrayType, T.MapType, T.StructType)):
        return f"{sql_type(kind.elementType)}[]"
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return "JSONB"
    return SQL_TYPES.get(kind.simpleString(), "TEXT")


# Stands for a quoted empty field while reading; Spark would merge it with NULL.
QUOTED_EMPTY = "\u0000"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    """CSV with a header and declared types.

    An unquoted empty field is NULL, a quoted one is an empty text, quotes are
    doubled inside quotes, and a value of the wrong type fails the read.
    ``multi_line`` is needed for line breaks inside quotes; such files cannot be
    split, so it is off unless asked for.
    """
    rows = (spark.read.schema(schema).option("header", True).option("escape", '"').option("mode", "FAILFAST")
            .option("emptyValue", QUOTED_EMPTY).option("multiLine", multi_line).csv(path))
    texts = [f.name for f in rows.schema if isinstance(f.dataType, T.StringType)]
    return rows.withColumns({c: F.when(F.col(c) == QUOTED_EMPTY, "").otherwise(F.col(c)) for c in texts})


def infer_schema(spark: SparkSession, path: str, rows: int = 1000) -> DataFrame:
    """(position, column_name, sql_type) inferred from the first ``rows`` records of a CSV.

    As in a data frame with NaN, whole numbers with gaps become doubles and
    booleans with gaps become text.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    names = reader.csv(path).columns
    sample = reader.csv(path).limit(rows)
    checks: list[Column] = []
    for name in names:
        value = F.col(f"`{name}`")
        kinds = {"b": value.rlike("^(?i:true|false)$"), "i": value.try_cast("bigint").isNotNull(),
                 "d": value.try_cast("double").isNotNull()}
        checks.append(F.struct(
            F.count(value).alias("n"), F.count(F.lit(1)).alias("all"),
            *[F.count_if(test).alias(kind) for kind, test in kinds.items()]).alias(name))
    found = sample.agg(*checks)
    described = [F.struct(F.lit(i).alias("position"), F.lit(n).alias("column_name"), F.col(f"`{n}`").alias("c"))
                 for i, n in enumerate(names)]
    c = F.col("c")
    kind = (F.when(c["n"] == 0, "DOUBLE PRECISION")
            .when(c["b"] == c["all"], "BOOLEAN")
            .when(c["i"] == c["all"], "BIGINT")
            .when(c["d"] == c["n"], "DOUBLE PRECISION")
            .otherwise("TEXT"))
    return found.select(F.inline(F.array(*described))).select("position", "column_name", kind.alias("sql_type"))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the catalog, or a Parquet path. Columns and filters chosen later reach the scan."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
              partitions: int, fetch_rows: int = 50_000, **options: str) -> DataFrame:
    """A database table in ``partitions`` parallel ranges of an integer column."""
    return (spark.read.format("jdbc").option("url", url).option("dbtable", table)
            .option("partitionColumn", column).option("lowerBound", lower).option("upperBound", upper)
            .option("numPartitions", partitions).option("fetchsize", fetch_rows).options(**options).load())


def column_list(df: DataFrame) -> DataFrame:
    """(position, column_name, sql_type, n_values): the columns in order with their non-null counts."""
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f.name) for f in df.schema])
    described = [F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                          F.lit(sql_type(f.dataType)).alias("sql_type"),
                          F.col(f"`{f.name}`").alias("n_values")) for i, f in enumerate(df.schema)]
    return counts.select(F.inline(F.array(*described)))


def parse_records(df: DataFrame, schema: T.StructType, body: str = "body") -> DataFrame:
    """Typed fields of a JSON text plus ``rejected``: the fields whose value has the wrong type.

    Every field is optional, others are ignored. A number may come as a number
    or as numeric text; a whole-number field takes no fraction; a text field
    takes any scalar. ``rejected`` is [body] when the text is no JSON object.
    Use ``accepted`` and ``quarantined`` to separate.
    """
    longs = [f.name for f in schema if isinstance(f.dataType, T.LongType)]
    doubles = [f.name for f in schema if isinstance(f.dataType, T.DoubleType)]

    def wrong(name: Column, value: Column) -> Column:
        return value.isNotNull() & ((name.isin(longs) & whole_number(value).isNull())
                                    | (name.isin(doubles) & value.try_cast("double").isNull()))

    # The text is parsed once, into its present fields; a record usually has few of the declared ones.
    given = df.withColumn("_given", F.from_json(body, T.MapType(T.StringType(), T.StringType())))
    rejected = F.coalesce(F.map_keys(F.map_filter("_given", wrong)), F.array(F.lit(body)))

    def typed(f: T.StructField) -> Column:
        text = F.try_element_at("_given", F.lit(f.name))
        if isinstance(f.dataType, T.LongType):
            text = whole_number(text)
        elif not isinstance(f.dataType, T.StringType):
            text = text.try_cast(f.dataType)
        return text.alias(f.name)

    return given.select(*[F.col(f"`{c}`") for c in df.columns], rejected.alias("rejected"), *[typed(f) for f in schema])


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.size("rejected") == 0).drop("rejected")


def quarantined(parsed: DataFrame, body: str = "body") -> DataFrame:
    return parsed.where(F.size("rejected") > 0).select(body, "rejected")
