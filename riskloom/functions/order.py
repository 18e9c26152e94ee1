"""Sort order with the database's placement of NULL: above every value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascending(name: str) -> Column:
    return F.asc_nulls_last(name)


def descending(name: str) -> Column:
    return F.desc_nulls_first(name)
