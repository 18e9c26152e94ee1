"""Keys, cleaning and alignment of columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import join_keys

# The parts of each user key.
USER_KEYS = {
    "uid1": ("card1",),
    "uid2": ("card1", "card2"),
    "uid3": ("card1", "card2", "addr1", "P_emaildomain"),
    "uid4": ("card1", "card2", "addr1", "DeviceInfo"),
}

# Label, keys and time; sparse columns; columns that overfit.
DROPPED_COLUMNS = (
    "isFraud", "TransactionID", "TransactionDT",
    "id_24", "id_25", "id_07", "id_08", "id_21", "id_26", "id_27",
    "id_22", "id_23", "dist2", "D7", "id_18",
    "uid1", "card1",
)


def user_keys(df: DataFrame, keys: Iterable[str] = ("uid1",), parts: Mapping[str, tuple[str, ...]] = USER_KEYS) -> DataFrame:
    """Add user keys; missing parts read 'missing', so they share one (possibly hot) user."""
    return df.withColumns({k: join_keys(df.schema, parts[k]) for k in keys})


def hyphens_to_underscores(df: DataFrame) -> DataFrame:
    """Rename ``id-01`` style columns to ``id_01``."""
    return df.withColumnsRenamed({c: c.replace("-", "_") for c in df.columns if "-" in c})


def drop_listed(df: DataFrame, names: Sequence[str] = DROPPED_COLUMNS) -> DataFrame:
    return df.drop(*names)


def null_profile(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_ratio), sparsest first, from one aggregate over all columns."""
    names = list(names or df.columns)
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in names])
    return wide.unpivot([], names, "column_name", "null_ratio").orderBy(F.desc("null_ratio"), "column_name")


def drop_sparse(df: DataFrame, above: float = 0.9) -> DataFrame:
    """Drop the columns with a higher null ratio; reads one row per column."""
    sparse = [r["column_name"] for r in null_profile(df).where(F.col("null_ratio") > above).collect()]
    return df.drop(*sparse)


def downcast(df: DataFrame) -> DataFrame:
    """Doubles as 32-bit floats."""
    return df.withColumns({f.name: F.col(f.name).cast("float") for f in df.schema if isinstance(f.dataType, T.DoubleType)})


def feature_label(df: DataFrame, label: str = "isFraud", row_id: str = "TransactionID",
                  drop: Sequence[str] = DROPPED_COLUMNS) -> DataFrame:
    """Row id, label when there is one, and the modelling columns, in one frame keyed by id."""
    kept = [c for c in df.columns if c not in drop]
    return df.select(row_id, *([label] if label in df.columns else []), *kept)


def align(df: DataFrame, names: Sequence[str], fill: object = 0) -> DataFrame:
    """Exactly ``names`` in that order: absent columns become ``fill``, others are dropped, NULLs stay."""
    return df.select(*[F.col(n) if n in df.columns else F.lit(fill).alias(n) for n in names])


def to_numeric(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Numbers from text; NULL where the text is no number."""
    return df.withColumns({n: F.col(n).try_cast("double") for n in names})


def category_levels(df: DataFrame, name: str) -> DataFrame:
    """(level, n) of a text column, without NULL."""
    return df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("level")).agg(F.count(F.lit(1)).alias("n"))


def legit_rows(df: DataFrame, label: str = "isFraud") -> DataFrame:
    return df.where(F.col(label) == 0)


def case_label(cases: Sequence[tuple[Column, object]]) -> Column:
    """First matching case, NULL when none matches."""
    chain = F.when(cases[0][0], cases[0][1])
    for condition, value in cases[1:]:
        chain = chain.when(condition, value)
    return chain


def column_difference(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns of ``left`` that ``right`` lacks."""
    return [c for c in left.columns if c not in right.columns]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
