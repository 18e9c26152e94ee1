"""Numbers for text columns of any cardinality: frequency rank and label rate, as tables that are joined.

``count_levels`` counts rows and labels per column, level and fold in one
aggregate. ``fit_codes`` makes the code table from it: one row per level for
rows that were not fitted on (fold -1), and one per level and fold whose label
rate leaves that fold out, so that a row's own label never reaches its code.
Leaving a further fold out (``without``) is a matter of subtracting it.

The rank of a level is one more than the number of levels that are more
frequent. It comes from the table of distinct frequencies, of which there are at
most about the square root of twice the rows, so no column's levels ever meet in
one task. NULL is the level ``missing``; levels not seen in train have NULL
codes. Levels are never listed on the driver; a table is broadcast only if
Spark finds its files small.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.text import MISSING
from riskloom.session import scratch_path, written

FOLDS = 5
# Rows of the overall label rate that every level's rate is mixed with.
PRIOR_ROWS = 20.0
UNFITTED = -1


def fold_of(row_id: str, folds: int = FOLDS, seed: int = 42) -> Column:
    """A fold by a seeded hash of the id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{row_id}`").cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % folds).cast("int")


def count_levels(train: DataFrame, texts: Sequence[str], label: str, fold: Column) -> DataFrame:
    """(column_name, level, fold, n, labelled, yes), written once."""
    wide = train.select(fold.alias("_fold"), F.col(f"`{label}`").cast("int").alias("_label"),
                        *[F.coalesce(F.col(f"`{c}`"), F.lit(MISSING)).alias(c) for c in texts])
    rows = wide.unpivot(["_fold", "_label"], list(texts), "column_name", "level")
    return written(rows.groupBy("column_name", "level", F.col("_fold").alias("fold")).agg(
        F.count(F.lit(1)).alias("n"), F.count("_label").alias("labelled"),
        F.coalesce(F.sum("_label"), F.lit(0)).alias("yes")), "level_counts")


@dataclass(frozen=True)
class Codes:
    """The code table at ``path``, by column: (column_name, level, fold, rank, rate)."""

    path: str
    texts: tuple[str, ...]

    @property
    def names(self) -> list[str]:
        return [f"{c}_{kind}" for c in self.texts for kind in ("rank", "rate")]

    def add(self, df: DataFrame, fold: Column | None = None) -> DataFrame:
        """``df`` with rank and rate of every column. ``fold`` is given for rows the table was fitted on."""
        if not self.texts:
            return df
        table = df.sparkSession.read.parquet(self.path)
        kept = df.columns
        out = df.withColumn("_code_fold", fold if fold is not None else F.lit(UNFITTED))
        for c in self.texts:
            # One folder per column: Spark knows the size of what it joins.
            own = table.where(F.col("column_name") == c).select(
                F.col("level").alias("_level"), F.col("fold").alias("_fold"), F.col("rank").alias(f"{c}_rank"),
                F.col("rate").alias(f"{c}_rate"))
            if fold is None:
                own = own.where(F.col("_fold") == UNFITTED)
            out = out.join(own, (F.coalesce(F.col(f"`{c}`"), F.lit(MISSING)) == own["_level"])
                           & (F.col("_code_fold") == own["_fold"]), "left").drop("_level", "_fold")
        return out.select(*[F.col(f"`{c}`") for c in kept if c not in self.names], *[F.col(f"`{n}`") for n in self.names])


def code_table(counts: DataFrame, without: int | None = None, prior_rows: float = PRIOR_ROWS) -> DataFrame:
    """(column_name, level, fold, rank, rate) from ``count_levels``, as if the rows of fold ``without`` were not there."""
    if without is not None:
        counts = counts.where(F.col("fold") != without)
    levels = counts.groupBy("column_name", "level").agg(*[F.sum(c).alias(f"all_{c}") for c in ("n", "labelled", "yes")])
    frequencies = levels.groupBy("column_name", "all_n").agg(F.count(F.lit(1)).alias("levels"))
    above = Window.partitionBy("column_name").orderBy(F.desc("all_n")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = frequencies.select(F.col("column_name").alias("_c"), F.col("all_n").alias("_n"),
                               (F.coalesce(F.sum("levels").over(above), F.lit(0)) + 1).alias("rank"))
    ranked = levels.join(ranks, (F.col("column_name") == F.col("_c")) & (F.col("all_n") == F.col("_n"))).drop("_c", "_n")
    # Every column has every row, so any of them gives the overall rate.
    overall = levels.groupBy("column_name").agg((F.sum("all_yes") / F.sum("all_labelled")).alias("prior"))
    ranked = ranked.join(F.broadcast(overall.withColumnRenamed("column_name", "_p")), F.col("column_name") == F.col("_p")).drop("_p")
    mixed = lambda yes, rows: (yes + F.col("prior") * prior_rows) / (rows + F.lit(prior_rows))
    unfitted = ranked.select("column_name", "level", F.lit(UNFITTED).alias("fold"), "rank",
                             mixed(F.col("all_yes"), F.col("all_labelled")).alias("rate"))
    own = counts.select(F.col("column_name").alias("_c"), F.col("level").alias("_l"), "fold", "labelled", "yes")
    fitted = ranked.join(own, (F.col("column_name") == F.col("_c")) & (F.col("level") == F.col("_l"))).select(
        "column_name", "level", "fold", "rank",
        mixed(F.col("all_yes") - F.col("yes"), F.col("all_labelled") - F.col("labelled")).alias("rate"))
    return unfitted.unionByName(fitted)


def fit_codes(counts: DataFrame, texts: Sequence[str], without: int | None = None, path: str | None = None) -> Codes:
    """Writes the code table of ``counts`` to ``path`` (default: the shared folder)."""
    path = path or scratch_path(counts.sparkSession, "codes")
    code_table(counts, without).write.mode("overwrite").partitionBy("column_name").parquet(path)
    return Codes(path, tuple(texts))


def no_codes(spark: SparkSession) -> Codes:
    return Codes("", ())
