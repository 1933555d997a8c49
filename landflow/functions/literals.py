"""Literals that mean the same on every machine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(value: dt.datetime | Column) -> Column:
    """A point in time as TIMESTAMP; times without a zone are UTC, not the driver's local time."""
    if not isinstance(value, dt.datetime):
        return value
    return F.lit(value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)).cast("timestamp")
