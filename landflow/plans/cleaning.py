"""The cleaning stage: an ordered list of column steps, applied in one projection.

Steps nest as expressions per column, so a table with hundreds of columns is
analysed once, however many steps its configuration enables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landflow.config import EntityConfig, parse_type
from landflow.functions import clean
from landflow.operators.projection import cols, quoted, remove_columns, select_required
from landflow.operators.rules import HEADER_FAULTS


@dataclass(frozen=True)
class Step:
    """One cleaning rule: which columns it touches and what it does to them."""

    name: str
    applies: Callable[[str], bool]
    change: Callable[[str, Column], Column]


def _steps(config: EntityConfig) -> dict[str, Step]:
    ints, doubles = set(config.cast_to_int_columns), set(config.cast_to_double_columns)
    typed = ints | doubles | set(config.decimal_cal_columns)

    def on(names) -> Callable[[str], bool]:
        chosen = set(names)
        return lambda n: n in chosen

    def text(n: str) -> bool:
        return n not in typed and not config.skip_trim

    placeholders = clean.PLACEHOLDERS if config.placeholders is None else config.placeholders
    steps = [
        Step("cast_long", on(ints), lambda n, c: clean.cast_long(c)),
        Step("cast_double", on(doubles), lambda n, c: clean.cast_double(c)),
        Step("fill_null", on(ints), lambda n, c: clean.fill_null(c, 0)),
        Step(
            "strip_symbols",
            on(config.column_cleanup_columns),
            lambda n, c: clean.strip_symbols(c, config.symbol_replacement),
        ),
        Step("digits_only", on(config.Integer_cleanup_columns), lambda n, c: clean.digits_only(c)),
        Step("strip_nbsp", text, lambda n, c: clean.strip_nbsp(c)),
        Step("trim_spaces", text, lambda n, c: clean.trim_spaces(c)),
        Step(
            "placeholder_to_blank",
            on(config.replace_zero_null),
            lambda n, c: clean.placeholder_to_blank(c, placeholders),
        ),
        Step("edi_cleanup", on(config.edi_cleanup_columns), lambda n, c: clean.edi_cleanup(c)),
        Step(
            "scale_decimal",
            on(config.decimal_cal_columns),
            lambda n, c: clean.scale_decimal(c, config.decimal_cal_columns[n]),
        ),
    ]
    return {step.name: step for step in steps}


# The order of the cleaning rules for delimited files and for workbooks.
CSV_ORDER = [
    "cast_long", "fill_null", "strip_symbols", "digits_only", "strip_nbsp", "trim_spaces",
    "placeholder_to_blank",
]
WORKBOOK_ORDER = [
    "strip_symbols", "scale_decimal", "cast_long", "cast_double", "fill_null", "strip_nbsp",
    "trim_spaces", "digits_only", "placeholder_to_blank", "edi_cleanup",
]


def rule_order(config: EntityConfig) -> list[str]:
    """Names of the steps that apply, in order."""
    workbook = config.input_file_extension.lower() in ("xlsx", "xlsm", "xlsb", "xls")
    return list(WORKBOOK_ORDER if workbook else CSV_ORDER)


def clean_columns(df: DataFrame, config: EntityConfig, order: Sequence[str] | None = None) -> DataFrame:
    """Cleaned text columns of a rule-list configuration, in one projection."""
    trimmed = remove_columns(df, config.remove_columns) if config.remove_columns else df
    steps = _steps(config)

    def cleaned(name: str) -> Column:
        c = F.col(quoted(name))
        if name == HEADER_FAULTS:
            return c
        for step_name in order or rule_order(config):
            step = steps[step_name]
            if step.applies(name):
                c = step.change(name, c)
        return c.alias(name)

    return trimmed.select(*[cleaned(n) for n in trimmed.columns])


def clean_declared(df: DataFrame, config: EntityConfig) -> DataFrame:
    """Text cleaning of a type-map configuration; values stay text until ``cast_declared``."""
    checks = config.dq_checks

    def cleaned(name: str, type_text: str) -> Column:
        c = F.col(quoted(name))
        numeric = type_text.startswith(("decimal", "numeric"))
        if numeric and checks.remove_alpha_from_numeric:
            # leaves digits, sign and point, so the other steps have nothing left to do
            return clean.numeric_chars_only(c).alias(name)
        if checks.trim_spaces:
            c = clean.trim_spaces(c)
        if checks.remove_special_characters:
            c = clean.strip_control_chars(c)
        if checks.decimal_column_normalization and numeric:
            c = clean.strip_thousands(c)
        return c.alias(name)

    declared = select_required(df, config.columns)
    extra = [c for c in df.columns if c not in config.column_type_map]
    return df.select(
        *[cleaned(n, config.type_of(n)) for n in declared.columns], *cols(extra)
    )


def cast_declared(df: DataFrame, config: EntityConfig) -> DataFrame:
    """Final types of the type map; values that do not parse become null."""
    types = config.column_type_map

    def typed(name: str) -> Column:
        c = F.col(quoted(name))
        return clean.cast_declared(c, parse_type(config.type_of(name))).alias(name) if name in types else c

    return df.select(*[typed(n) for n in df.columns])


def standardize_times(df: DataFrame, config: EntityConfig) -> DataFrame:
    """Date and timestamp columns parsed by their configured formats."""
    changes = {n: clean.excel_serial_date(F.col(quoted(n))) for n in config.convert_to_date}
    changes |= {
        n: clean.standardize_date(F.col(quoted(n)), f) for n, f in config.date_columns.items()
    }
    changes |= {
        n: clean.standardize_timestamp(F.col(quoted(n)), f)
        for n, f in config.timestamp_columns.items()
    }
    return df.withColumns(changes) if changes else df
