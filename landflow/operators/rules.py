"""Row rules, evaluated together in one pass.

Each rule is a predicate that is true for a *failing* row.  ``apply_rules``
gathers all failures of a row in one array column, so the number of rules adds
no scan and no job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landflow.functions import clean
from landflow.functions.enrich import row_hash
from landflow.functions.literals import moment
from landflow.operators.projection import cols, quoted

REJECTS = "_rejects"
#: Failures of a row's whole file that the reader found in its header.
HEADER_FAULTS = "_header_faults"


@dataclass(frozen=True)
class Rule:
    reason: str
    column: str
    failed: Column


def integer_rule(name: str) -> Rule:
    c = F.col(quoted(name))
    return Rule(f"{name}_integer_format_incorrect", name, clean.cast_long(c).isNull())


def notnull_rule(name: str) -> Rule:
    return Rule(f"{name}_null_check_failed", name, clean.is_blank(F.col(quoted(name))))


def malformed_rule(name: str) -> Rule:
    """The reader's column for records with more or fewer fields than declared."""
    return Rule("record_malformed", name, F.col(quoted(name)).isNotNull())


def cast_rule(name: str, parsed: Column) -> Rule:
    """A value that is there but does not parse as its declared type."""
    return Rule(f"{name}_type_incorrect", name, ~clean.is_blank(F.col(quoted(name))) & parsed.isNull())


def date_rule(name: str, fmt: str) -> Rule:
    c = F.col(quoted(name))
    bad = ~clean.is_blank(c) & clean.standardize_date(c, fmt).isNull()
    return Rule(f"{name}_date_format_incorrect", name, bad)


def timestamp_rule(name: str, fmt: str) -> Rule:
    c = F.col(quoted(name))
    bad = ~clean.is_blank(c) & clean.standardize_timestamp(c, fmt).isNull()
    return Rule(f"{name}_timestamp_format_incorrect", name, bad)


def watermark_rule(name: str, lower: dt.datetime, upper: dt.datetime) -> Rule:
    """Missing, before ``lower`` or after ``upper`` (the run's own time)."""
    c = F.col(quoted(name)).cast("timestamp")
    bad = c.isNull() | (c < moment(lower)) | (c > moment(upper))
    return Rule(f"{name}_watermark_out_of_bounds", name, bad)


def hash_rule(name: str, columns: Sequence[str], null_safe: bool = False) -> Rule:
    """Stored hash missing or unlike the recomputed one."""
    c = F.col(quoted(name))
    return Rule(f"{name}_hash_mismatch", name, c.isNull() | (c != row_hash(columns, null_safe)))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the array of ``(reason, column)`` failures of each row, after those of its file's header."""
    if HEADER_FAULTS in df.columns:
        own = apply_rules(df.withColumnRenamed(HEADER_FAULTS, "_faults"), rules)
        return own.withColumn(REJECTS, F.concat("_faults", REJECTS)).drop("_faults")
    entries = [
        F.when(rule.failed, F.struct(F.lit(rule.reason).alias("reason"), F.lit(rule.column).alias("column")))
        for rule in rules
    ]
    if not entries:
        empty = F.array().cast("array<struct<reason:string,column:string>>")
        return df.withColumn(REJECTS, empty)
    return df.withColumn(REJECTS, F.array_compact(F.array(*entries)))


def passed(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(REJECTS) == 0).drop(REJECTS)


def passing(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows no rule fails.

    The same rows as ``passed(apply_rules(df, rules))`` from a plain condition,
    which the optimizer can evaluate early and stop at the first failure.
    """
    if HEADER_FAULTS in df.columns:
        df = df.filter(F.size(HEADER_FAULTS) == 0).drop(HEADER_FAULTS)
    for rule in rules:
        df = df.filter(~F.coalesce(rule.failed, F.lit(False)))
    return df


def failed(checked: DataFrame) -> DataFrame:
    """Failing rows with sorted reason and column arrays."""
    ordered = F.array_sort(F.col(REJECTS))
    return checked.filter(F.size(REJECTS) > 0).select(
        *cols(c for c in checked.columns if c != REJECTS),
        F.transform(ordered, lambda r: r["reason"]).alias("reject_reason"),
        F.transform(ordered, lambda r: r["column"]).alias("rejected_column"),
    )


def union_rejects(checked: DataFrame) -> DataFrame:
    """One row per failure: the record, its reason and its column."""
    names = [c for c in checked.columns if c != REJECTS]
    exploded = checked.select(*cols(names), F.explode(REJECTS).alias("_r"))
    return exploded.select(
        *cols(names),
        F.col("_r.reason").alias("reject_reason"),
        F.col("_r.column").alias("rejected_column"),
    )


def reject_summary(rejects: DataFrame) -> DataFrame:
    """One row per rejected record with its reasons and columns.

    Copies of a record are counted before they are gathered, so the arrays hold
    one entry per failed rule however often the record occurs; ``occurrences``
    says how often each was raised.
    """
    names = [c for c in rejects.columns if c not in ("reject_reason", "rejected_column")]
    counted = rejects.groupBy(*cols(names), "reject_reason", "rejected_column").agg(
        F.count(F.lit(1)).alias("_n")
    )
    gathered = counted.groupBy(*cols(names)).agg(
        F.array_sort(
            F.collect_list(F.struct("reject_reason", "rejected_column", "_n"))
        ).alias("_r")
    )
    return gathered.select(
        *cols(names),
        F.transform("_r", lambda r: r["reject_reason"]).alias("reject_reason"),
        F.transform("_r", lambda r: r["rejected_column"]).alias("rejected_column"),
        F.transform("_r", lambda r: r["_n"]).alias("occurrences"),
    )


def reject_sample(rejects: DataFrame, order: Sequence[str], size: int = 5) -> DataFrame:
    """The first few rejects, for display."""
    return rejects.orderBy(*cols(order)).limit(size)


def step_counts(checked: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Landing, clean and rejected row counts from one aggregation."""
    return checked.groupBy(*cols(group)).agg(
        F.count(F.lit(1)).alias("landing_count"),
        F.count_if(F.size(REJECTS) == 0).alias("raw_count"),
        F.count_if(F.size(REJECTS) > 0).alias("reject_count"),
    )


def file_verdict(counts: DataFrame) -> DataFrame:
    """Whole-file outcome: any reject fails the file, no rows at all is an empty file."""
    # the texts are fixed values
    n, bad = F.col("landing_count"), F.col("reject_count")
    return counts.withColumns(
        {
            "executionstatus": F.when(n == 0, "Empty").when(bad > 0, "Failed").otherwise("Succeeded"),
            "errormessage": F.when(n == 0, F.lit("Full File Rejected as we have zero records"))
            .when(bad > 0, F.format_string("Full File Rejected as we have %d rejection records", bad))
            .otherwise(F.lit("")),
        }
    )


def withhold_failed_files(checked: DataFrame, verdicts: DataFrame, file_column: str) -> DataFrame:
    """Clean rows of files that passed as a whole."""
    good = verdicts.filter(F.col("executionstatus") == "Succeeded").select(quoted(file_column))
    return passed(checked).join(good, file_column, "left_semi")


# ---------------------------------------------------------------- rules that look at other rows

#: Reasons of the two rules below.
KEY_NOT_UNIQUE, REPLAYED = "business_key_not_unique", "already_published"


def _with_failure(df: DataFrame, bad: Column, reason: str, columns: Sequence[str]) -> DataFrame:
    """Add a failure to the array of ``apply_rules`` (an empty one where there is none yet)."""
    empty = F.array().cast("array<struct<reason:string,column:string>>")
    held = F.col(REJECTS) if REJECTS in df.columns else empty
    failure = F.struct(F.lit(reason).alias("reason"), F.lit(",".join(columns)).alias("column"))
    return df.withColumn(REJECTS, F.when(F.coalesce(bad, F.lit(False)), F.concat(held, F.array(failure))).otherwise(held))


def key_unique_rule(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail every row whose key other rows of the batch have as well.

    Only keys that repeat come back from the count, and the join that marks their rows splits large keys.
    """
    repeated = df.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    left, right = df.alias("l"), repeated.alias("r")
    same = [F.col(f"l.{quoted(k)}").eqNullSafe(F.col(f"r.{quoted(k)}")) for k in keys]
    joined = left.join(right, same, "left").select("l.*", F.col("r._n").isNotNull().alias("_bad"))
    return _with_failure(joined, F.col("_bad"), KEY_NOT_UNIQUE, keys).drop("_bad")


def replay_rule(
    df: DataFrame, published: DataFrame, keys: Sequence[str], watermark: str, hash_column: str
) -> DataFrame:
    """Fail rows that are already published with the same key, watermark and hash."""
    on = [*keys, watermark, hash_column]
    seen = published.select(*cols(on)).distinct().withColumn("_seen", F.lit(True)).alias("r")
    left = df.alias("l")
    same = [F.col(f"l.{quoted(k)}").eqNullSafe(F.col(f"r.{quoted(k)}")) for k in on]
    joined = left.join(seen, same, "left").select("l.*", F.col("r._seen").alias("_bad"))
    return _with_failure(joined, F.col("_bad"), REPLAYED, on).drop("_bad")
