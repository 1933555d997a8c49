"""Derived columns: keys, constants, quarters, priorities, hashes, audit stamps."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landflow.config import ConfigError
from landflow.functions.literals import moment

#: Text standing for null in the null-safe row hash.
NULL_MARK = "\\N"


def concat_key(*columns: Column, sep: str = "-") -> Column:
    return F.concat_ws(sep, *columns)


def calendar_quarter(c: Column) -> Column:
    """DATE or TIMESTAMP to ``YYYY-Qn``."""
    return F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string"))


def calendar_quarter_text(c: Column) -> Column:
    """``YYYY-MM...`` text to ``YYYY-Qn``; null when shorter than seven characters."""
    month = F.substring(c, 6, 2).try_cast("int")
    quarter = F.ceil(month / 3).cast("int").cast("string")
    return F.when(F.length(c) >= 7, F.concat(F.substring(c, 1, 4), F.lit("-Q"), quarter))


def type_priority(c: Column) -> Column:
    """Booked revenue before backlog before the rest."""
    return F.when(c == "REV", 1).when(c == "BACKLOG", 2).otherwise(3)


def quantity_priority(quantity: Column, revenue: Column) -> Column:
    return (
        F.when((quantity != 0) & (revenue != 0), 1)
        .when((quantity == 0) & (revenue != 0), 2)
        .otherwise(3)
    )


def lookup(c: Column, table: Mapping[str, Any], default: Any = None) -> Column:
    """Value of a small literal table, without a join."""
    result = None
    for key, value in table.items():
        branch = (c == key, F.lit(value))
        result = F.when(*branch) if result is None else result.when(*branch)
    if result is None:
        return F.lit(default)
    return result if default is None else result.otherwise(F.lit(default))


def row_hash(columns: Sequence[Column | str], null_safe: bool = False) -> Column:
    """SHA-256 of the ``|``-joined columns, in hex.

    Joining skips nulls, so ``(a, null, b)`` and ``(a, b, null)`` collide;
    ``null_safe`` writes a mark in their place.
    """
    texts = [(F.col(f"`{c}`") if isinstance(c, str) else c).cast("string") for c in columns]
    if null_safe:
        texts = [F.coalesce(t, F.lit(NULL_MARK)) for t in texts]
    return F.sha2(F.concat_ws("|", *texts), 256)


def audit_columns(
    run_ts: dt.datetime,
    source_file: Column | str,
    created_by: str = "landflow",
    source_nm: str = "landflow",
    watermark_column: str | None = None,
) -> dict[str, Column]:
    """Load stamps, all from the run's own timestamp so that a rerun gives equal rows."""
    stamp = moment(run_ts)
    columns = {
        "batch_run_dt": stamp,
        "created_by": F.lit(created_by),
        "create_dt": stamp,
        "source_nm": F.lit(source_nm),
        "source_file_name": F.lit(source_file) if isinstance(source_file, str) else source_file,
        "ingestion_ts": stamp,
    }
    if watermark_column:
        columns["watermark"] = F.col(f"`{watermark_column}`")
    return columns


#: Scalar functions a configuration may name.
SCALAR_FUNCTIONS: dict[str, Callable[..., Column]] = {}


def register_scalar(name: str, builder: Callable[..., Column]) -> None:
    SCALAR_FUNCTIONS[name] = builder


def _quarter_of(column: Column) -> Column:
    # dates print as yyyy-MM-dd, so one text rule serves dates and texts alike
    return calendar_quarter_text(column.cast("string"))


# Fixed value: the name configurations use for the quarter function.
register_scalar("fiscal_quarter_from_date", _quarter_of)


def mapped_column(spec: Mapping[str, Any]) -> Column:
    """One ``column_mapping`` entry to a Column."""
    if "concat_ws" in spec:
        body = spec["concat_ws"]
        return F.concat_ws(body["sep"], *[F.col(f"`{c}`") for c in body["columns"]])
    if "lit" in spec:
        return F.lit(spec["lit"])
    if "function" in spec:
        name = spec["function"]
        if name not in SCALAR_FUNCTIONS:
            raise ConfigError(f"unknown scalar function: {name!r}")
        return SCALAR_FUNCTIONS[name](*[F.col(f"`{c}`") for c in spec.get("args", [])])
    raise ConfigError(f"unknown column mapping: {dict(spec)!r}")


def apply_mapping(df: DataFrame, mapping: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """All mapped columns in one projection; existing columns are replaced."""
    return df.withColumns({name: mapped_column(spec) for name, spec in mapping.items()})


Processor = Callable[[DataFrame], DataFrame]


class ProcessorRegistry:
    """Per-entity ``DataFrame -> DataFrame`` hooks, run after the rules and before hashing."""

    def __init__(self) -> None:
        self._hooks: dict[str, Processor] = {}

    def register(self, logical_name: str, hook: Processor) -> None:
        self._hooks[logical_name] = hook

    def apply(self, df: DataFrame, logical_name: str) -> DataFrame:
        hook = self._hooks.get(logical_name)
        return df if hook is None else df.transform(hook)
