"""Wide month and country columns to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landflow.functions.clean import null_to_blank
from landflow.operators.projection import cols, quoted


def unpivot_months(
    df: DataFrame,
    ids: Sequence[str],
    label: str,
    value: str,
    months: Sequence[str] | None = None,
) -> DataFrame:
    """One row per id and month column; labels are the column names, gaps become blank."""
    months = list(months) if months else [c for c in df.columns if c not in set(ids)]
    long = df.unpivot(cols(ids), cols(months), label, value)
    return long.withColumn(value, null_to_blank(F.col(quoted(value))))


def melt_leading_ids(df: DataFrame, label: str, value: str, id_count: int = 3) -> DataFrame:
    """The first ``id_count`` columns identify a row, all others are melted."""
    return unpivot_months(df, df.columns[:id_count], label, value)


def melt_outer_ids(
    df: DataFrame, label: str, value: str, leading: int = 3, trailing: int = 5
) -> DataFrame:
    """Ids at both ends, melted columns between; label and value follow the leading ids."""
    first, last = df.columns[:leading], df.columns[len(df.columns) - trailing :]
    long = unpivot_months(df, [*first, *last], label, value)
    return long.select(*cols([*first, label, value, *last]))
