"""Declarative entity configuration.

One :class:`EntityConfig` describes one logical table: how its files are named
and read, the ordered names and types of its columns, which rules apply, how it
is keyed and hashed, and how it is published.
"""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

from pyspark.sql import types as T

DEFAULT_DECIMAL = T.DecimalType(30, 15)

_SIMPLE_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "long": T.LongType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "smallint": T.ShortType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


#: Fixed value: the reason for refusing a file that nothing would check.
NO_CHECKS = "no data-quality check is enabled"


class ConfigError(ValueError):
    """The configuration cannot be used."""


def parse_type(text: str) -> T.DataType:
    """``'decimal(18,4)'`` -> ``DecimalType(18, 4)``; bare ``decimal`` -> (30,15)."""
    name = text.strip().lower()
    if name in _SIMPLE_TYPES:
        return _SIMPLE_TYPES[name]
    if name in ("decimal", "numeric"):
        return DEFAULT_DECIMAL
    found = re.fullmatch(r"(?:decimal|numeric)\((\d+)\s*,\s*(\d+)\)", name)
    if not found:
        raise ConfigError(f"unknown column type: {text!r}")
    return T.DecimalType(int(found[1]), int(found[2]))


@dataclass(frozen=True)
class DqChecks:
    """Switches of the row rules."""

    trim_spaces: bool = False
    remove_special_characters: bool = False
    remove_alpha_from_numeric: bool = False
    row_duplicate_check: bool = False
    null_notnull_check: bool = False
    decimal_column_normalization: bool = False
    business_key_unique_check: bool = False
    replay_check: bool = False

    @property
    def any_enabled(self) -> bool:
        return any(getattr(self, f.name) for f in fields(self))


@dataclass(frozen=True)
class EntityConfig:
    """All settings of one logical table.  Unknown JSON keys land in ``extra``."""

    # reading
    input_file_extension: str = "csv"
    file_pattern: str | None = None
    sheet_name: str | None = None
    delimiter: str = ","
    encoding: str = "UTF-8"
    header_row_number_to_select: int = 0
    remove_trailer_rows: int = 0
    columns_to_select: int = 0
    allowed_prefixes: tuple[str, ...] = ("",)
    force_column_names: bool = False
    unknown_columns: str = "reject"
    #: columns that stay text whatever type is declared
    string_columns: tuple[str, ...] = ()
    # admission of files
    admission: bool = False
    max_sla_hours: float = 2
    manifest_prefix: str = "metadata_"
    #: a file with a rejected row is rejected whole
    reject_files: bool = False
    # columns
    column_type_map: dict[str, str] = field(default_factory=dict)
    required_column_list: tuple[str, ...] = ()
    remove_columns: tuple[str, ...] = ()
    # cleaning and rules
    dq_checks: DqChecks | None = None
    notnull_columns: tuple[str, ...] = ()
    int_columns: tuple[str, ...] = ()
    date_columns: dict[str, str] = field(default_factory=dict)
    timestamp_columns: dict[str, str] = field(default_factory=dict)
    convert_to_date: tuple[str, ...] = ()
    column_cleanup_columns: tuple[str, ...] = ()
    Integer_cleanup_columns: tuple[str, ...] = ()
    edi_cleanup_columns: tuple[str, ...] = ()
    replace_zero_null: tuple[str, ...] = ()
    cast_to_int_columns: tuple[str, ...] = ()
    cast_to_double_columns: tuple[str, ...] = ()
    decimal_cal_columns: dict[str, int] = field(default_factory=dict)
    drop_null_data_columns: tuple[str, ...] = ()
    symbol_replacement: dict[str, str] = field(default_factory=dict)
    placeholders: tuple[str, ...] | None = None
    skip_trim: bool = False
    allow_duplicates: int = -1
    duplicate_policy: dict[str, str] = field(default_factory=dict)
    # enrichment, keys, publishing
    column_mapping: dict[str, Any] = field(default_factory=dict)
    primary_columns: tuple[str, ...] = ()
    primary_key_columns: tuple[str, ...] = ()
    hash_columns: tuple[str, ...] = ()
    hash_column_name: str = "record_hash"
    partition_cols: tuple[str, ...] = ()
    watermark_column: str | None = None
    load_type: str = "scd2"
    curated_table: str | None = None
    published_table: str | None = None
    created_by: str = "landflow"
    source_nm: str = "landflow"
    extra: dict[str, Any] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        """Declared column names in file order."""
        return list(self.column_type_map) or list(self.required_column_list)

    @property
    def keys(self) -> tuple[str, ...]:
        """The columns that tell one record from another: the key list, or the primary columns."""
        return self.primary_key_columns or self.partition_cols or self.primary_columns

    def type_of(self, name: str) -> str:
        """The declared type, which ``string_columns`` overrules."""
        return "string" if name in self.string_columns else self.column_type_map.get(name, "string")

    @property
    def date_key_columns(self) -> list[str]:
        """Key columns typed ``date`` (their missing value is a date, not blank).

        Both key lists count, and so do the date columns of a rule-list configuration.
        """
        keys = dict.fromkeys([*self.primary_key_columns, *self.partition_cols, *self.primary_columns])
        return [c for c in keys if self.type_of(c) == "date" or c in self.date_columns or c in self.convert_to_date]

    @property
    def has_checks(self) -> bool:
        """K10: whether any check is enabled; a list of columns alone is none."""
        if self.dq_checks is not None and self.dq_checks.any_enabled:
            return True
        return any((self.notnull_columns, self.int_columns, self.date_columns, self.timestamp_columns, self.column_cleanup_columns))

    def require_checks(self) -> None:
        """K10: a configuration that enables no check at all rejects the file."""
        if not self.has_checks:
            raise ConfigError(NO_CHECKS)

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> EntityConfig:
        known = {f.name: f for f in fields(cls)}
        values: dict[str, Any] = {}
        extra: dict[str, Any] = {}
        for key, value in raw.items():
            if key not in known or key == "extra":
                extra[key] = value
            elif key == "dq_checks":
                switches = {f.name for f in fields(DqChecks)}
                values[key] = DqChecks(**{k: bool(v) for k, v in value.items() if k in switches})
            elif key in ("date_columns", "timestamp_columns", "decimal_cal_columns"):
                values[key] = _merge_pairs(value)
            elif isinstance(value, list):
                values[key] = tuple(value)
            else:
                values[key] = value
        config = cls(**values, extra=extra)
        if config.load_type.lower() not in ("scd2", "snapshot", "full"):
            raise ConfigError(f"unknown load_type: {config.load_type!r}")
        for type_text in config.column_type_map.values():
            parse_type(type_text)
        return config


def _merge_pairs(value: Any) -> dict[str, Any]:
    """``[{"a": fmt}, {"b": fmt}]`` (or its text form, or one dict) -> one dict."""
    if isinstance(value, str):
        value = ast.literal_eval(value)
    if isinstance(value, Mapping):
        return dict(value)
    merged: dict[str, Any] = {}
    for pair in value:
        merged.update(pair)
    return merged


def load_configs(text: str) -> dict[tuple[str, str], EntityConfig]:
    """Read a JSON document ``{file_key: config}`` or ``{file_key: {table_key: config}}``.

    The result is keyed ``(file_key, table_key)``; one-table files use an empty
    table key.
    """
    document = json.loads(text)
    configs: dict[tuple[str, str], EntityConfig] = {}
    for file_key, body in document.items():
        nested = body and all(
            isinstance(v, dict) and ("required_column_list" in v or "column_type_map" in v)
            for v in body.values()
        )
        tables = body if nested else {"": body}
        for table_key, raw in tables.items():
            configs[(file_key, table_key)] = EntityConfig.from_dict(raw)
    return configs


def pick_config(
    configs: Mapping[tuple[str, str], EntityConfig], file_name: str
) -> dict[str, EntityConfig]:
    """Tables of the entity whose key prefixes ``file_name``; the first entity otherwise."""
    file_keys = list(dict.fromkeys(key for key, _ in configs))
    if not file_keys:
        raise ConfigError("no entity is configured")
    chosen = next((k for k in file_keys if file_name.startswith(k)), file_keys[0])
    return {table: cfg for (key, table), cfg in configs.items() if key == chosen}


def output_name(file_key: str, table_key: str, table_count: int) -> str:
    """Output folder of one table: ``key`` or, for multi-table files, ``key~table``."""
    return file_key if table_count <= 1 else f"{file_key}~{table_key.replace(' ', '_')}"
