"""File admission: one query over listing, manifest and configuration.

Every landed file gets a status and a single reason, the first failing rule in
order.  Inputs are DataFrames:

* listing: ``path, length, modificationTime``
* manifest: ``manifest_name, declared_size``
* entity rules are literal configuration and compile into expressions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landflow.functions.enrich import lookup
from landflow.functions.literals import moment
from landflow.operators.audit import HANDLED_STATUSES, VALIDATION_STEP

#: Sidecar files carry this prefix unless the configuration names another.
MANIFEST_PREFIX = "metadata_"

# How a data file name ends in its arrival time.
STAMPED_NAME = r"^([A-Za-z0-9_\-]+)_(\d{14})$"

ACCEPT, REJECT, AWAIT = "ACCEPTED", "REJECTED", "AWAIT"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(name: Column) -> Column:
    """Name up to the first dot."""
    return F.substring_index(name, ".", 1)


def extension(name: Column) -> Column:
    return F.lower(F.substring_index(name, ".", -1))


def logical_name(name: Column) -> Column:
    """Name without extension and without its last ``_`` part."""
    return F.regexp_replace(F.regexp_replace(name, r"\.[^.]*$", ""), r"_[^_]*$", "")


def stamped_base(name: Column) -> Column:
    """``<base>`` of ``<base>_<14 digits>``, null when the name is formed otherwise."""
    return F.nullif(F.regexp_extract(stem(name), STAMPED_NAME, 1), F.lit(""))


def stamped_time(name: Column) -> Column:
    digits = F.nullif(F.regexp_extract(stem(name), STAMPED_NAME, 2), F.lit(""))
    return F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmss"))


def manifest_target(name: Column, prefix: str = MANIFEST_PREFIX) -> Column:
    """Stem of the data file a manifest describes."""
    return F.when(
        name.startswith(prefix) & name.endswith(".csv"),
        F.regexp_replace(name.substr(F.lit(len(prefix) + 1), F.length(name)), r"\.csv$", ""),
    )


def has_prefix(name: Column, prefixes: Sequence[str]) -> Column:
    return reduce(or_, (name.startswith(p) for p in prefixes))


def entity_key(name: Column, aliases: Sequence[str]) -> Column:
    """First alias that prefixes or occurs in the base name, else the stem less its last 15 characters."""
    base = logical_name(name)
    s = stem(name)
    result = None
    for alias in aliases:
        hit = base.contains(alias)
        result = F.when(hit, alias) if result is None else result.when(hit, alias)
    rest = F.left(s, F.greatest(F.length(s) - 15, F.lit(0)))
    return rest if result is None else result.otherwise(rest)


def split_listing(listing: DataFrame, prefix: str = MANIFEST_PREFIX) -> tuple[DataFrame, DataFrame]:
    """``(data files, manifest files)``; folder entries are dropped."""
    named = listing.withColumn("file_name", file_name(F.col("path"))).filter("file_name <> ''")
    is_manifest = F.col("file_name").startswith(prefix)
    return named.filter(~is_manifest), named.filter(is_manifest)


def file_present(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """Expected files that have not landed."""
    landed = listing.select(file_name(F.col("path")).alias("file_name")).distinct()
    return expected.join(landed, "file_name", "left_anti")


def duplicate_arrivals(listing: DataFrame) -> DataFrame:
    """Base names that arrived more than once, with their count."""
    base = logical_name(file_name(F.col("path")))
    return listing.groupBy(base.alias("base_name")).agg(F.count(F.lit(1)).alias("arrivals")).filter(
        "arrivals > 1"
    )


def already_processed(
    listing: DataFrame, audit: DataFrame, batch: str, process: str = VALIDATION_STEP
) -> DataFrame:
    """Listing without the files this batch has handled before."""
    handled = audit.filter(
        (F.col("processname") == process)
        & (F.col("batchid") == batch)
        & F.col("executionstatus").isin(*HANDLED_STATUSES)
    ).select(F.col("sourcename").alias("file_name")).distinct()
    named = listing.withColumn("file_name", file_name(F.col("path")))
    return named.join(handled, "file_name", "left_anti").drop("file_name").select(*listing.columns)


def match_manifest(
    data: DataFrame, manifest: DataFrame, prefix: str = MANIFEST_PREFIX, by: str = "stem"
) -> DataFrame:
    """Left join data files with their manifest.

    ``by='stem'`` matches the whole stem; ``by='base'`` ignores the arrival times
    of both files.  Several manifests of one file reduce to the first by name;
    ``sizes_differ`` says that they declare unlike sizes, or only some declare one.
    """
    if by == "stem":
        left_key, right_key = stem(F.col("file_name")), manifest_target(F.col("manifest_name"), prefix)
    else:
        left_key = logical_name(F.col("file_name"))
        right_key = logical_name(manifest_target(F.col("manifest_name"), prefix))
    sizes = (
        manifest.withColumn("_key", right_key)
        .groupBy("_key")
        .agg(
            F.min("manifest_name").alias("manifest_name"),
            F.min_by("declared_size", "manifest_name").alias("declared_size"),
            (
                (F.min("declared_size") < F.max("declared_size"))
                | F.count("declared_size").between(F.lit(1), F.count(F.lit(1)) - 1)
            ).alias("sizes_differ"),
        )
    )
    return data.withColumn("_key", left_key).join(sizes, "_key", "left").drop("_key")


def admission_verdict(
    data: DataFrame,
    manifest: DataFrame,
    run_ts: dt.datetime,
    extensions: Mapping[str, str],
    prefixes: Sequence[str] = ("",),
    aliases: Sequence[str] = (),
    name_pattern: str | None = None,
    header_columns: DataFrame | None = None,
    column_counts: Mapping[str, int] | None = None,
    max_sla_hours: float = 2,
    manifest_prefix: str = MANIFEST_PREFIX,
    match_by: str = "stem",
    hold_unmatched: bool = True,
    duplicate_scope: str = "base",
) -> DataFrame:
    """Status and first failing rule of every data file.

    ``extensions`` maps entity keys to their expected file extension and so
    lists the configured entities.  ``header_columns`` (``path``,
    ``header_columns``) comes from reading the first lines; without it the
    header rule is not applied.  A header must have as many columns as
    ``column_counts`` lists for the entity, or at least one where it lists none.  With ``duplicate_scope='landing'`` one repeated
    base name fails every file of the landing, otherwise only the repeated ones.
    """
    name = F.col("file_name")
    files = data.withColumns(
        {
            "entity": entity_key(name, aliases or list(extensions)),
            "base_name": logical_name(name),
        }
    )
    files = match_manifest(files, manifest, manifest_prefix, match_by)
    repeated = duplicate_arrivals(data)
    files = files.join(repeated, "base_name", "left")
    if header_columns is not None:
        files = files.join(header_columns.select("path", "header_columns"), "path", "left")
    expected = lookup(F.col("entity"), extensions)
    size_ok = F.coalesce(F.col("length") == F.col("declared_size"), F.lit(False))
    ext_ok = F.coalesce(extension(name) == F.lower(expected), F.lit(False))
    age_hours = (
        F.unix_micros(moment(run_ts))
        - F.unix_micros(F.col("modificationTime").cast("timestamp"))
    ) / F.lit(3_600_000_000)
    any_repeat = (
        F.col("arrivals").isNotNull()
        if duplicate_scope == "base"
        else repeated.agg(F.count(F.lit(1))).scalar() > 0
    )

    held = (F.col("manifest_name").isNull() | expected.isNull()) if hold_unmatched else F.lit(False)
    # the reasons are fixed values
    rules: list[tuple[Column, str]] = [(~has_prefix(name, prefixes), "File naming pattern check failed")]
    if name_pattern:
        rules.append((~name.rlike(name_pattern), "File naming pattern check failed"))
    rules += [
        (F.col("manifest_name").isNull(), "Matching metadata file check failed"),
        (F.col("length") <= 0, "File size check failed (empty file)"),
        (F.coalesce("sizes_differ", F.lit(False)), "Metadata files declare different sizes"),
        (~size_ok & ~ext_ok, "File size and extension are not matched"),
        (~size_ok, "File size is not matched"),
        (~ext_ok, "File extension is not matched"),
    ]
    if header_columns is not None:
        found = F.coalesce(F.col("header_columns"), F.lit(0))
        counted = lookup(F.col("entity"), {k: str(n) for k, n in (column_counts or {}).items()}).cast("int")
        rules.append((F.coalesce(found != counted, found <= 0), "File integrity check failed"))
    rules += [
        (age_hours > max_sla_hours, "File timeliness/SLA check failed"),
        (any_repeat, "Duplicate check failed"),
    ]
    reason = F.coalesce(*[F.when(bad, text) for bad, text in rules])
    awaiting = F.when(F.col("manifest_name").isNull(), "No metadata file yet").otherwise("No entity configured")
    return files.withColumns(
        {
            "status": F.when(held, AWAIT).when(reason.isNotNull(), REJECT).otherwise(ACCEPT),
            "reason": F.when(held, awaiting).otherwise(reason),
        }
    ).select(
        "path", "file_name", "entity", "base_name", "length", "modificationTime",
        "manifest_name", "declared_size", "status", "reason",
    )
