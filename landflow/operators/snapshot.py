"""Snapshot and full loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landflow.operators.projection import cols, quoted


def snapshot_rows(
    staging: DataFrame, snapshot_date: dt.date, date_column: str = "snapshot_date"
) -> DataFrame:
    """The batch as one new snapshot, to be written as its own partition."""
    return staging.withColumn(date_column, F.lit(snapshot_date))


def latest_snapshot(
    snapshots: DataFrame, date_column: str = "snapshot_date", flag: str = "is_latest_fg"
) -> DataFrame:
    """All snapshots with the newest flagged ``Y``.

    The flag follows from the newest partition, so loading a snapshot never
    rewrites the older ones.
    """
    newest = snapshots.agg(F.max(quoted(date_column))).scalar()
    on = F.col(quoted(date_column)) == newest
    return snapshots.withColumn(flag, F.when(on, "Y").otherwise("N"))


def snapshot_flip(
    published: DataFrame, staging: DataFrame, flag: str = "active_flag"
) -> DataFrame:
    """Table state after a flip: all earlier rows inactive, the whole batch active."""
    names = [c for c in published.columns if c != flag]
    before = published.select(*cols(names), F.lit("N").alias(flag))
    return before.unionByName(staging.select(*cols(names), F.lit("Y").alias(flag)))


def full_load(published: DataFrame, staging: DataFrame) -> DataFrame:
    """Table state after truncate and insert: the batch in the table's columns and types."""
    return staging.select(
        *[F.col(quoted(name)).cast(kind).alias(name) for name, kind in published.dtypes]
    )
