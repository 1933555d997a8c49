"""Reporting aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landflow.operators.filters import current_only
from landflow.operators.projection import cols, quoted


def report_rollup(
    published: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str],
    flag: str | None = "is_current_fg",
) -> DataFrame:
    """Sums of measures per key over current rows; ``measures`` maps output to input."""
    rows = current_only(published, flag) if flag else published
    sums = [F.sum(quoted(source)).alias(name) for name, source in measures.items()]
    return rows.groupBy(*cols(keys)).agg(*sums)
