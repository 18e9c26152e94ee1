"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 of a wall-clock timestamp.

    Built from calendar fields, so a timestamp without time zone gives the same
    number whatever the session time zone is.
    """
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
