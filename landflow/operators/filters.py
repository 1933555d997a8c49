"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landflow.operators.projection import cols, quoted


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def not_null_filter(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep rows whose required columns are neither null nor blank."""
    return df.filter(_all(c.isNotNull() & (c.cast("string") != "") for c in cols(names)))


def drop_null_subset(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(names)) if names else df


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which every column is null or blank."""
    filled = [F.nullif(F.trim(c.cast("string")), F.lit("")) for c in cols(df.columns)]
    return df.filter(F.coalesce(*filled).isNotNull())


def business_exclusions(
    df: DataFrame, order_column: str, line_column: str, total_mark: str = "Grand", bad_mark: str = "?"
) -> DataFrame:
    """Drop total lines and unreadable ids; rows with a null id go too."""
    order, line = F.col(quoted(order_column)), F.col(quoted(line_column))
    return df.filter(
        ~order.contains(total_mark) & ~line.contains(bad_mark) & ~order.contains(bad_mark)
    )


def nonneg_measure(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(quoted(column)) >= 0)


def region_filter(df: DataFrame, column: str, segment: str) -> DataFrame:
    return df.filter(F.trim(F.col(quoted(column))) == segment)


def current_only(df: DataFrame, flag: str = "is_current_fg", value: object = "Y") -> DataFrame:
    return df.filter(F.col(quoted(flag)) == F.lit(value))
