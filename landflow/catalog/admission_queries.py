"""File admission over a listing and manifests derived from orders: one file per order."""

from __future__ import annotations

from pyspark.sql import functions as F

from landflow.catalog.base import query, table, utc
from landflow.operators import admission as A

_STEM = """concat(CASE o_orderpriority WHEN '1-URGENT' THEN 'ORD_URGENT' WHEN '2-HIGH' THEN 'ORD_HIGH'
      WHEN '3-MEDIUM' THEN 'SHIP_MEDIUM' WHEN '4-NOT SPECIFIED' THEN 'OTHER_PLAIN' ELSE 'stray low' END, '_',
      CAST(o_custkey AS STRING), o_orderstatus, '_', lpad(CAST(o_orderkey AS STRING), 14, '2'))"""
_LISTING = [
    f"concat('landing/', {_STEM}, CASE WHEN o_custkey % 29 = 0 THEN '.XLSX' ELSE '.csv' END) AS path",
    "CASE WHEN o_custkey % 37 = 0 THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END AS length",
    "CAST(o_orderdate AS TIMESTAMP) AS modificationTime",
]
#: Large orders come with a manifest; some manifests are off by one.
_MANIFEST = [
    f"concat('metadata_', {_STEM}, '.csv') AS manifest_name",
    "CAST(floor(o_totalprice) AS BIGINT) + CASE WHEN o_custkey % 31 = 0 THEN 1 ELSE 0 END AS declared_size",
]
_HAS_MANIFEST = "o_totalprice >= 5000"
_BASE = "regexp_replace(regexp_replace(file_name, '\\.[^.]*$', ''), '_[^_]*$', '')"
_ENTITY = (
    f"CASE WHEN {_BASE} LIKE '%ORD_URGENT%' THEN 'ORD_URGENT' WHEN {_BASE} LIKE '%ORD_HIGH%' THEN 'ORD_HIGH' "
    f"WHEN {_BASE} LIKE '%SHIP%' THEN 'SHIP' "
    "ELSE left(split_part(file_name, '.', 1), greatest(length(split_part(file_name, '.', 1)) - 15, 0)) END"
)
_FILES_SQL = f"""listing AS (SELECT {', '.join(_LISTING)} FROM orders),
  manifest AS (SELECT {', '.join(_MANIFEST)} FROM orders WHERE {_HAS_MANIFEST}),
  named AS (SELECT *, replace(path, 'landing/', '') AS file_name FROM listing),
  based AS (SELECT *, {_BASE} AS base_name, {_ENTITY} AS entity, split_part(file_name, '.', 1) AS stem FROM named),
  repeated AS (SELECT base_name, count(*) AS arrivals FROM based GROUP BY base_name HAVING count(*) > 1),
  described AS (SELECT replace(replace(manifest_name, 'metadata_', ''), '.csv', '') AS stem, manifest_name, declared_size FROM manifest)"""


def listing(spark, d):
    return table(spark, d, "orders").selectExpr(*_LISTING)


def manifest(spark, d):
    return table(spark, d, "orders").filter(_HAS_MANIFEST).selectExpr(*_MANIFEST)


EXTENSIONS = {"ORD_URGENT": "csv", "ORD_HIGH": "csv", "SHIP": "csv"}
_EXPECTED = "CASE WHEN entity IN ('ORD_URGENT', 'ORD_HIGH', 'SHIP') THEN 'csv' END"


def _verdict_sql(held: bool, scope: str) -> str:
    hold = f"manifest_name IS NULL OR ({_EXPECTED}) IS NULL" if held else "false"
    repeat = "arrivals IS NOT NULL" if scope == "base" else "(SELECT count(*) FROM repeated) > 0"
    size_ok = "coalesce(length = declared_size, false)"
    ext_ok = f"coalesce(lower(regexp_extract(file_name, '[^.]*$')) = ({_EXPECTED}), false)"
    reason = f"""CASE WHEN NOT (file_name LIKE 'ORD%' OR file_name LIKE 'SHIP%' OR file_name LIKE 'OTHER%') THEN 'File naming pattern check failed'
      WHEN NOT regexp_matches(file_name, '^[A-Za-z0-9_]+_[0-9]{{14}}[.][A-Za-z]+$') THEN 'File naming pattern check failed'
      WHEN manifest_name IS NULL THEN 'Matching metadata file check failed'
      WHEN length <= 0 THEN 'File size check failed (empty file)'
      WHEN NOT {size_ok} AND NOT {ext_ok} THEN 'File size and extension are not matched'
      WHEN NOT {size_ok} THEN 'File size is not matched' WHEN NOT {ext_ok} THEN 'File extension is not matched'
      WHEN TIMESTAMP '2001-08-02 00:00:00' - modificationTime > INTERVAL 17520 HOUR THEN 'File timeliness/SLA check failed'
      WHEN {repeat} THEN 'Duplicate check failed' END"""
    return f"""WITH {_FILES_SQL}, judged AS (SELECT based.*, manifest_name, declared_size, ({hold}) AS held, {reason} AS failure
        FROM based LEFT JOIN described USING (stem) LEFT JOIN repeated USING (base_name))
      SELECT path, file_name, entity, base_name, length, modificationTime, manifest_name, declared_size,
        CASE WHEN held THEN 'AWAIT' WHEN failure IS NOT NULL THEN 'REJECTED' ELSE 'ACCEPTED' END AS status,
        CASE WHEN held THEN CASE WHEN manifest_name IS NULL THEN 'No metadata file yet' ELSE 'No entity configured' END ELSE failure END AS reason
      FROM judged"""


def _verdict(spark, d, **more):
    data, _ = A.split_listing(listing(spark, d))
    return A.admission_verdict(
        data, manifest(spark, d), utc("2001-08-02 00:00:00"), EXTENSIONS,
        prefixes=["ORD", "SHIP", "OTHER"], name_pattern=r"^[A-Za-z0-9_]+_[0-9]{14}[.][A-Za-z]+$",
        max_sla_hours=17_520, **more,
    )


@query("file_admission", "B2 B3 B4 B5 B6 B7 B8 B9 B10 B12 B13 B15", _verdict_sql(True, "base"))
def file_admission(spark, d):
    return _verdict(spark, d)


@query("file_admission_strict", "B6 B13 B15", _verdict_sql(False, "landing"))
def file_admission_strict(spark, d):
    """No file is held back, and one repeated arrival fails the whole landing."""
    return _verdict(spark, d, hold_unmatched=False, duplicate_scope="landing")


@query(
    "file_present", "B1",
    """SELECT concat('order_', CAST(o_orderkey AS VARCHAR), '.csv') AS file_name FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def file_present(spark, d):
    """Every order expects a file; the files that landed are those of orders with lines."""
    expected = table(spark, d, "orders").selectExpr(
        "concat('order_', CAST(o_orderkey AS STRING), '.csv') AS file_name"
    )
    landed = table(spark, d, "lineitem").selectExpr(
        "concat('landing/order_', CAST(l_orderkey AS STRING), '.csv') AS path"
    )
    return A.file_present(expected, landed)


@query(
    "name_parts", "B3 B4",
    f"""WITH {_FILES_SQL} SELECT file_name, base_name AS logical_name,
        CASE WHEN regexp_matches(stem, '^[A-Za-z0-9_-]+_[0-9]{{14}}$') THEN regexp_replace(stem, '_[0-9]{{14}}$', '') END AS stamped_base,
        CASE WHEN regexp_matches(stem, '^[A-Za-z0-9_-]+_[0-9]{{14}}$') THEN concat('metadata_', stem, '.csv') END AS manifest_name
        FROM based""",
)
def name_parts(spark, d):
    name = A.file_name(F.col("path"))
    stamped = A.stamped_base(name)
    described = F.concat(F.lit("metadata_"), A.stem(name), F.lit(".csv"))
    return listing(spark, d).select(
        name.alias("file_name"),
        A.logical_name(name).alias("logical_name"),
        stamped.alias("stamped_base"),
        F.when(A.manifest_target(described) == A.stem(name), F.when(stamped.isNotNull(), described)).alias("manifest_name"),
    )


@query(
    "duplicate_arrivals", "B13",
    f"WITH {_FILES_SQL} SELECT base_name, arrivals FROM repeated",
)
def duplicate_arrivals(spark, d):
    return A.duplicate_arrivals(listing(spark, d))


_FILE_AUDIT = """CASE o_orderstatus WHEN 'F' THEN 'Succeeded' WHEN 'P' THEN 'FileValidationFailed' ELSE 'ReadyToExecute' END"""


@query(
    "already_processed", "B14",
    f"""WITH {_FILES_SQL}, handled AS (SELECT replace(path, 'landing/', '') AS file_name FROM (SELECT {', '.join(_LISTING)}, {_FILE_AUDIT} AS st,
          o_orderdate FROM orders) WHERE st IN ('Succeeded', 'ReadyToExecute') AND o_orderdate < DATE '2000-01-01')
        SELECT path, length, modificationTime FROM named WHERE file_name NOT IN (SELECT file_name FROM handled)""",
)
def already_processed(spark, d):
    audit = table(spark, d, "orders").select(
        A.file_name(F.expr(_LISTING[0].rsplit(" AS ", 1)[0])).alias("sourcename"),
        F.lit("FileValidation").alias("processname"),
        F.when(F.col("o_orderdate") < F.lit("2000-01-01").cast("date"), "AMSBatch_1").otherwise("AMSBatch_0").alias("batchid"),
        F.expr(_FILE_AUDIT).alias("executionstatus"),
    )
    return A.already_processed(listing(spark, d), audit, "AMSBatch_1")
