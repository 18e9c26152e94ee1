"""Text expressions: user keys, labels, formatted numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING = "missing"


def key_text(column: Column, data_type: T.DataType) -> Column:
    """Text of one key part; NULL becomes 'missing'.

    A whole double prints without its fraction (408.0 -> '408'), also beyond
    the point where Spark would switch to scientific notation.
    """
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        wide = column.cast("double")
        whole = (wide == F.floor(wide)) & (F.abs(wide) < 1e15)
        text = F.when(whole, wide.cast("bigint").cast("string")).otherwise(wide.cast("string"))
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(MISSING))


def join_keys(schema: T.StructType, names: tuple[str, ...], separator: str = "_") -> Column:
    return F.concat_ws(separator, *[key_text(F.col(n), schema[n].dataType) for n in names])


def label_lookup(column: Column, labels: dict[str, str]) -> Column:
    """Readable label of a name, or the name itself when it has none."""
    if not labels:
        return column
    chain = reduce(lambda acc, kv: acc.when(column == kv[0], F.lit(kv[1])), list(labels.items())[1:],
                   F.when(column == next(iter(labels)), F.lit(next(iter(labels.values())))))
    return chain.otherwise(column)


def percent_text(probability: Column) -> Column:
    """Two decimals, half-even on the binary value."""
    return F.format_number(probability, 2)
