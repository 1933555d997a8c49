"""One entity from raw text rows to the rows that are ready to publish.

Everything is lazy: the caller decides what to write.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landflow.config import EntityConfig, parse_type
from landflow.functions import clean
from landflow.functions.enrich import ProcessorRegistry, apply_mapping, audit_columns, row_hash
from landflow.operators import rules as R
from landflow.operators.duplicates import (
    DuplicatePolicy,
    choose_policy,
    counted_copies,
    drop_duplicates,
    priority_dedup,
    row_duplicate_policy,
)
from landflow.operators.filters import drop_null_subset
from landflow.operators.projection import cols, evaluated, quoted
from landflow.plans import cleaning
from landflow.sources.readers import MALFORMED, SOURCE_FILE, SOURCE_PATH


#: Rows that landed for one checked row, where copies have been dropped.
LANDED = "_landed"


@dataclass(frozen=True)
class CheckedEntity:
    """``checked`` holds every row with its failures; the rest are views of it.

    Where equal copies are dropped, ``LANDED`` says how many rows one of ``checked`` stands for.

    ``typed`` turns passing rows of a written ``checked`` into ``clean`` ones, so that a run reads and
    cleans the raw data once.
    """

    checked: DataFrame
    clean: DataFrame
    rejects: DataFrame
    counts: DataFrame
    typed: Callable[[DataFrame], DataFrame]


def entity_rules(config: EntityConfig, columns: Sequence[str] = ()) -> list[R.Rule]:
    """The row rules a configuration asks for: integers, required values, dates, timestamps, declared types.

    Records that the reader marked as malformed (``columns`` has its mark) fail a rule of their own.
    """
    found = [R.malformed_rule(MALFORMED)] if MALFORMED in columns else []
    found += [R.integer_rule(n) for n in config.int_columns]
    for name in config.column_type_map:
        if (kind := config.type_of(name)) != "string":
            found.append(R.cast_rule(name, clean.cast_declared(F.col(quoted(name)), parse_type(kind))))
    if config.dq_checks is None or config.dq_checks.null_notnull_check:
        found += [R.notnull_rule(n) for n in config.notnull_columns]
    found += [R.date_rule(n, f) for n, f in config.date_columns.items()]
    found += [R.timestamp_rule(n, f) for n, f in config.timestamp_columns.items()]
    return found


def check_entity(
    raw: DataFrame, config: EntityConfig, region: str = "", one_per_key_follows: bool = False
) -> CheckedEntity:
    """Clean, de-duplicate, apply the rules and type the passing rows.

    When ``prepare_for_publish`` reduces the rows to one per key anyway,
    ``one_per_key_follows`` saves the shuffle that removes equal copies first.
    """
    config.require_checks()
    if config.column_type_map:
        return _check_declared(raw, config, one_per_key_follows)
    return _check_listed(raw, config, region)


def _check_declared(raw: DataFrame, config: EntityConfig, keep_copies: bool) -> CheckedEntity:
    text = cleaning.clean_declared(raw, config)
    once = evaluated(text)
    if config.dq_checks.row_duplicate_check and not keep_copies:
        text, once = counted_copies(text, LANDED), drop_duplicates(once)
    rules = entity_rules(config, text.columns)
    checked = R.apply_rules(text, rules)
    return CheckedEntity(
        checked=checked,
        clean=cleaning.cast_declared(R.passing(once, rules), config).drop(MALFORMED),
        rejects=R.failed(checked.drop(LANDED)),
        counts=R.step_counts(checked),
        typed=lambda rows: cleaning.cast_declared(rows, config).drop(MALFORMED),
    )


def _check_listed(raw: DataFrame, config: EntityConfig, region: str) -> CheckedEntity:
    text = cleaning.clean_columns(drop_null_subset(raw, config.drop_null_data_columns), config)
    policy = choose_policy(region, config.duplicate_policy, config.allow_duplicates)
    kept, surplus = row_duplicate_policy(text, policy)
    rules = entity_rules(config, kept.columns)
    checked = R.apply_rules(counted_copies(text, LANDED) if policy is DuplicatePolicy.DROP else kept, rules)
    if policy is DuplicatePolicy.REJECT:
        copy = F.struct(F.col("reject_reason").alias("reason"), F.col("rejected_column").alias("column"))
        copies = surplus.select(*cols(text.columns), F.array(copy).alias("_copy"))
        if R.HEADER_FAULTS in text.columns:
            # columns of such a file are missing or unsure, so equal rows are no copies: each has its own failures
            copies = copies.withColumn("_copy", F.when(F.size(R.HEADER_FAULTS) == 0, F.col("_copy")))
            copies = R.apply_rules(copies, rules).withColumn(R.REJECTS, F.coalesce("_copy", R.REJECTS)).drop("_copy")
        else:
            copies = copies.withColumnRenamed("_copy", R.REJECTS)
        checked = checked.unionByName(copies)
    return CheckedEntity(
        checked=checked,
        clean=cleaning.standardize_times(R.passing(kept, rules), config).drop(MALFORMED),
        rejects=R.failed(checked.drop(LANDED)),
        counts=R.step_counts(checked),
        typed=lambda rows: cleaning.standardize_times(rows, config).drop(MALFORMED),
    )


def prepare_for_publish(
    clean: DataFrame,
    config: EntityConfig,
    run_ts: dt.datetime,
    logical_name: str = "",
    processors: ProcessorRegistry | None = None,
    dedup_order: list[Column] | None = None,
    source_file: str | None = None,
    null_safe_hash: bool = False,
    one_per_key: bool = True,
) -> DataFrame:
    """One row per key, enriched, hashed and stamped.

    With ``one_per_key`` off all rows of a key stay, for a history that makes versions of them.
    Enrichment comes before hashing because mapped columns are hash inputs.
    Ties between rows of one key are settled by all their columns.
    """
    keys = list(config.partition_cols or config.keys)
    df = priority_dedup(clean, keys, dedup_order or []) if keys and one_per_key else clean
    df = apply_mapping(df, config.column_mapping) if config.column_mapping else df
    df = processors.apply(df, logical_name) if processors else df
    if source_file is not None or SOURCE_FILE not in df.columns:
        origin: Column = F.lit(source_file or "unknown")
    else:
        origin = F.col(SOURCE_FILE)
    stamps = audit_columns(
        run_ts, origin, config.created_by, config.source_nm, config.watermark_column
    )
    if config.hash_columns:
        stamps[config.hash_column_name] = row_hash(config.hash_columns, null_safe_hash)
    return df.withColumns(stamps).drop(SOURCE_FILE, SOURCE_PATH)


def dedup_by_priority(kind: str, quantity: str, revenue: str) -> list[Column]:
    """Order for ``prepare_for_publish``: booked before backlog, then by measures."""
    from landflow.functions.enrich import quantity_priority, type_priority

    return [
        type_priority(F.col(quoted(kind))),
        quantity_priority(F.col(quoted(quantity)), F.col(quoted(revenue))),
    ]
