"""Column selection, renaming and pruning, always in one projection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class MissingColumnsError(ValueError):
    """A declared column is absent from the input."""


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def cols(names: Iterable[str]) -> list:
    return [F.col(quoted(n)) for n in names]


def select_required(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing columns: {missing}")
    return df.select(*cols(names))


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise MissingColumnsError(f"expected {len(names)} columns, got {len(df.columns)}")
    return df.toDF(*names)


def first_n_columns(df: DataFrame, count: int) -> DataFrame:
    return df.select(*cols(df.columns[:count]))


def drop_unnamed(df: DataFrame) -> DataFrame:
    return df.select(*cols(c for c in df.columns if c.strip() and not c.startswith("Unnamed")))


def remove_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    dropped = set(names)
    return df.select(*cols(c for c in df.columns if c not in dropped))


def evaluated(df: DataFrame) -> DataFrame:
    """The same rows, with every column computed here once.

    Conditions on the columns stay above; pushed below, each would compute the columns it names again, and
    the condition's code would outgrow what the JVM compiles.
    """
    return df.select(F.inline(F.array(F.struct(*cols(df.columns)))))
