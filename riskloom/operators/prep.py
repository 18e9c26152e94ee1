"""Fitted preprocessing: levels from train, means and deviations from legit train rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.text import MISSING
from riskloom.operators.columns import legit_rows, numeric_columns, text_columns

# Fixed value: text columns with fewer distinct values than this are encoded.
HIGH_CARDINALITY = 100


def level_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column_name, level, n) over several text columns in one pass; NULL is a level of its own."""
    return df.select(*names).unpivot([], list(names), "column_name", "level").groupBy("column_name", "level").agg(
        F.count(F.lit(1)).alias("n"))


def cardinality(df: DataFrame, names: Sequence[str] | None = None, limit: int = HIGH_CARDINALITY) -> DataFrame:
    """(column_name, n_distinct, encoded): distinct non-null levels per text column."""
    counts = level_counts(df, names or text_columns(df)).groupBy("column_name").agg(
        F.count("level").alias("n_distinct"))
    return counts.withColumn("encoded", F.col("n_distinct") < limit)


@dataclass(frozen=True)
class LevelEncoding:
    """Levels per encoded column, 'missing' included where train has NULLs; ``dropped`` were too many-valued."""

    levels: Mapping[str, tuple[str, ...]]
    dropped: tuple[str, ...]

    @property
    def pairs(self) -> list[tuple[str, str]]:
        return [(c, v) for c, values in self.levels.items() for v in values]

    @property
    def names(self) -> list[str]:
        """column_level, with dots as underscores: a dot would read as a struct field."""
        names: list[str] = []
        for c, v in self.pairs:
            name = f"{c}_{v}".replace(".", "_")
            names.append(name if name not in names else f"{name}_{len(names)}")
        return names

    def columns(self) -> list[Column]:
        """One 0/1 float per level; unseen levels give all zeros."""
        return [F.when(F.coalesce(F.col(c), F.lit(MISSING)) == v, 1.0).otherwise(0.0).cast("float") for c, v in self.pairs]

    def transform(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` plus the dummies."""
        return df.select(*keep, *[c.alias(name) for c, name in zip(self.columns(), self.names)])


def fit_levels(train: DataFrame, names: Sequence[str] | None = None, limit: int = HIGH_CARDINALITY) -> LevelEncoding:
    """Levels of the low-cardinality text columns; fewer than ``limit`` + 1 values per column reach the driver."""
    names = list(names or text_columns(train))
    if not names:
        return LevelEncoding({}, ())
    # A sketch removes the clearly many-valued columns before the exact count.
    sketch = train.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first()
    candidates = [c for c in names if sketch[c] < 2 * limit]
    if not candidates:
        return LevelEncoding({}, tuple(names))
    counts = level_counts(train, candidates)
    few = (counts.groupBy("column_name").agg(F.count("level").alias("k"), F.collect_set(F.coalesce("level", F.lit(MISSING))).alias("v"))
           .where(F.col("k") < limit).collect())
    found = {r["column_name"]: tuple(sorted(r["v"])) for r in few}
    levels = {c: found[c] for c in names if c in found}
    return LevelEncoding(levels, tuple(c for c in names if c not in levels))


# Category names of one column that the driver may hold.
MAX_CATEGORIES = 100_000


def fit_categories(train: DataFrame, names: Sequence[str], most: int = MAX_CATEGORIES) -> StringIndexerModel:
    """Category numbers from train, most frequent first, ties by name; unseen and NULL share one more number.

    The fitted model lists every category, so the columns are measured first.
    """
    sizes = train.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first().asDict()
    if large := {c: n for c, n in sizes.items() if n > most}:
        raise ValueError(f"too many categories for a model: {large}")
    return StringIndexer(inputCols=list(names), outputCols=[f"{c}_index" for c in names], handleInvalid="keep",
                         stringOrderType="frequencyDesc").fit(train)


@dataclass(frozen=True)
class NumericScaling:
    """Mean and population deviation per column; ``dropped`` had no value to average."""

    means: Mapping[str, float]
    deviations: Mapping[str, float]
    dropped: tuple[str, ...]

    @property
    def names(self) -> list[str]:
        return list(self.means)

    def impute(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in self.means.items()})

    def columns(self) -> list[Column]:
        """z-score per column; a missing value sits at the mean."""
        return [(F.coalesce(F.col(c).cast("double"), F.lit(m)) - F.lit(m)) / F.lit(self.deviations[c])
                for c, m in self.means.items()]

    def transform(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` plus the z-scores."""
        return df.select(*keep, *[z.alias(c) for z, c in zip(self.columns(), self.names)])


def fit_scaling(train: DataFrame, names: Sequence[str] | None = None, label: str = "isFraud") -> NumericScaling:
    """Two aggregates over the legit rows: means, then deviations of the imputed column."""
    names = list(names or [c for c in numeric_columns(train) if c != label])
    legit = legit_rows(train, label)
    means_row = legit.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in names]).first()
    means = {c: means_row[c] for c in names if means_row[c] is not None}
    if not means:
        return NumericScaling({}, {}, tuple(names))
    rows = F.count(F.lit(1))
    spread_row = legit.agg(*[
        F.sqrt(F.coalesce(F.sum((F.col(c) - F.lit(m)) * (F.col(c) - F.lit(m))), F.lit(0.0)) / rows).alias(c)
        for c, m in means.items()]).first()
    deviations = {c: spread_row[c] or 1.0 for c in means}
    return NumericScaling(means, deviations, tuple(c for c in names if c not in means))


def with_matrix(df: DataFrame, levels: LevelEncoding, scaling: NumericScaling, output: str = "features") -> DataFrame:
    """All columns plus one vector of dummies followed by z-scores; its names are ``levels.names + scaling.names``."""
    kept = df.columns
    entries = [*levels.columns(), *scaling.columns()]
    temporary = [f"_entry_{i}" for i in range(len(entries))]
    wide = df.select("*", *[e.alias(t) for e, t in zip(entries, temporary)])
    return VectorAssembler(inputCols=temporary, outputCol=output).transform(wide).select(*kept, output)


def numeric_matrix(df: DataFrame, levels: LevelEncoding, scaling: NumericScaling, keep: Sequence[str],
                   output: str = "features") -> DataFrame:
    """``keep`` plus the vector."""
    return with_matrix(df, levels, scaling, output).select(*keep, output)
