"""Whole entity loads: from raw text to checked, prepared and published rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from landflow.catalog.base import (
    DIRTY_ORDERS_SQL, RUN_1, RUN_2, SPLIT_DAY, dirty_orders, query, table,
)
from landflow.catalog.history_queries import OPEN, T1, T2
from landflow.catalog.rule_queries import BAD_DATE, BAD_INTEGER, BAD_TIME
from landflow.config import EntityConfig
from landflow.operators.history import HistorySpec
from landflow.operators.report import report_rollup
from landflow.plans import entity_load, publish
from landflow.session import scratch_path
from landflow.sources import sinks

# Column names and key lists of this entity's files and table.
REVENUE = EntityConfig.from_dict(
    {
        "input_file_extension": "csv",
        "column_type_map": {
            "cp_backlog_sni_revenue": "string",
            "region": "string",
            "order_type": "string",
            "order_create_calendar_date": "date",
            "sales_order_identifier": "string",
            "sales_order_line_item_number": "string",
            "source_type": "string",
            "sum_of_sales_order_base_quantity": "decimal(30,15)",
            "sum_of_cp_gross_revenue_(usd)": "decimal(30,15)",
            "process_timestamp": "timestamp",
        },
        "dq_checks": {
            "trim_spaces": True, "remove_special_characters": True, "remove_alpha_from_numeric": True,
            "row_duplicate_check": True, "null_notnull_check": True, "decimal_column_normalization": True,
        },
        "notnull_columns": ["sales_order_identifier", "order_type"],
        "column_mapping": {
            "sap_order_key": {
                "concat_ws": {"sep": "-", "columns": ["sales_order_identifier", "sales_order_line_item_number"]}
            },
            "region_id": {"lit": 500},
            "fiscal_quarter": {"function": "fiscal_quarter_from_date", "args": ["order_create_calendar_date"]},
        },
        "primary_key_columns": [
            "order_type", "order_create_calendar_date", "sales_order_identifier",
            "sales_order_line_item_number", "source_type",
        ],
        "partition_cols": [
            "order_type", "order_create_calendar_date", "sales_order_identifier",
            "sales_order_line_item_number", "source_type", "region",
        ],
        "hash_columns": [
            "cp_backlog_sni_revenue", "fiscal_quarter", "region", "region_id", "sap_order_key",
            "sum_of_cp_gross_revenue_(usd)", "sum_of_sales_order_base_quantity",
        ],
        "watermark_column": "process_timestamp",
        "load_type": "scd2",
        "created_by": "loader",
        "source_nm": "landing",
    }
)

_RAW = [
    "concat(' ', CASE l_returnflag WHEN 'R' THEN 'REV' WHEN 'A' THEN 'BACKLOG' ELSE 'SNI' END) AS cp_backlog_sni_revenue",
    "concat(c_mktsegment, chr(9)) AS region",
    "CASE WHEN l_suppkey % 40 = 0 THEN '  ' ELSE o_orderpriority END AS order_type",
    "CAST(CAST(o_orderdate AS DATE) AS STRING) AS order_create_calendar_date",
    "CAST(l_orderkey AS STRING) AS sales_order_identifier",
    "concat(CAST(l_linenumber AS STRING), ' ') AS sales_order_line_item_number",
    "l_linestatus AS source_type",
    "concat('1,', CAST(CAST(l_quantity AS DECIMAL(18,2)) AS STRING), ' pcs') AS sum_of_sales_order_base_quantity",
    "concat('USD ', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)) AS `sum_of_cp_gross_revenue_(usd)`",
    "CAST(CAST(l_shipdate AS TIMESTAMP) AS STRING) AS process_timestamp",
]
_RAW_SQL = ", ".join(_RAW).replace("`", '"')
_JOINED = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"


def raw_revenue(spark, d, number: int | None = None):
    """Order lines as an untidy all-text extract; one of two extracts, or all."""
    lines = table(spark, d, "lineitem")
    if number is not None:
        early = F.col("l_shipdate") < F.lit(dt.date.fromisoformat(SPLIT_DAY))
        lines = lines.filter(early if number == 1 else ~early)
    # the few orders meet the customers, so that lines are shuffled by their order only
    orders = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(*_RAW)


def prepared_revenue(spark, d, run_ts, number: int | None = None, source: str = "revenue.csv"):
    checked = entity_load.check_entity(
        raw_revenue(spark, d, number), REVENUE, one_per_key_follows=True
    )
    order = entity_load.dedup_by_priority(
        "cp_backlog_sni_revenue", "sum_of_sales_order_base_quantity", "sum_of_cp_gross_revenue_(usd)"
    )
    return entity_load.prepare_for_publish(
        checked.clean, REVENUE, run_ts, dedup_order=order, source_file=source
    )


_CLEAN_SQL = f"""raw AS (SELECT {_RAW_SQL}, CASE WHEN l_shipdate < DATE '{SPLIT_DAY}' THEN 1 ELSE 2 END AS extract_no FROM {_JOINED}),
  typed AS (SELECT DISTINCT extract_no, trim(cp_backlog_sni_revenue) AS cp_backlog_sni_revenue, trim(region, chr(9)) AS region, trim(order_type) AS order_type,
    CAST(order_create_calendar_date AS DATE) AS order_create_calendar_date, sales_order_identifier, trim(sales_order_line_item_number) AS sales_order_line_item_number,
    source_type, CAST(regexp_replace(sum_of_sales_order_base_quantity, '[^0-9.]', '', 'g') AS DECIMAL(30,15)) AS sum_of_sales_order_base_quantity,
    CAST(regexp_replace("sum_of_cp_gross_revenue_(usd)", '[^0-9.]', '', 'g') AS DECIMAL(30,15)) AS "sum_of_cp_gross_revenue_(usd)",
    CAST(process_timestamp AS TIMESTAMP) AS process_timestamp FROM raw),
  passing AS (SELECT * FROM typed WHERE order_type <> '')"""
_LOAD_KEYS = "order_type, order_create_calendar_date, sales_order_identifier, sales_order_line_item_number, source_type, region"


def _prepared_sql(partition: str, stamp: str, source: str) -> str:
    return f"""(SELECT *, sha256(concat_ws('|', cp_backlog_sni_revenue, fiscal_quarter, region, CAST(region_id AS VARCHAR), sap_order_key,
      CAST("sum_of_cp_gross_revenue_(usd)" AS VARCHAR), CAST(sum_of_sales_order_base_quantity AS VARCHAR))) AS record_hash FROM
      (SELECT * EXCLUDE (rn), sales_order_identifier || '-' || sales_order_line_item_number AS sap_order_key, 500 AS region_id,
        concat(CAST(year(order_create_calendar_date) AS VARCHAR), '-Q', CAST(quarter(order_create_calendar_date) AS VARCHAR)) AS fiscal_quarter,
        {stamp} AS batch_run_dt, 'loader' AS created_by, {stamp} AS create_dt, 'landing' AS source_nm, {source} AS source_file_name,
        {stamp} AS ingestion_ts, process_timestamp AS watermark
       FROM (SELECT *, row_number() OVER (PARTITION BY {partition}{_LOAD_KEYS} ORDER BY
         CASE cp_backlog_sni_revenue WHEN 'REV' THEN 1 WHEN 'BACKLOG' THEN 2 ELSE 3 END, cp_backlog_sni_revenue,
         sum_of_sales_order_base_quantity, "sum_of_cp_gross_revenue_(usd)", process_timestamp) AS rn FROM passing) WHERE rn = 1))"""


_ALL_SQL = f"""WITH {_CLEAN_SQL.replace("SELECT DISTINCT extract_no, ", "SELECT DISTINCT ")}"""


@query(
    "entity_load", "C1 C7 C8 C11 C12 C17 I4 D1 G1 C33 N1 C29 C30 C31 K12",
    f"{_ALL_SQL} SELECT * FROM {_prepared_sql('', T1, chr(39) + 'revenue.csv' + chr(39))}",
)
def entity_load_query(spark, d):
    return prepared_revenue(spark, d, RUN_1)


@query(
    "entity_rejects", "K2 K12",
    f"""{_ALL_SQL} SELECT sales_order_identifier, sales_order_line_item_number, region, 'order_type_null_check_failed' AS reject_reason
        FROM typed WHERE order_type = ''""",
)
def entity_rejects(spark, d):
    rejects = entity_load.check_entity(raw_revenue(spark, d), REVENUE).rejects
    return rejects.select(
        "sales_order_identifier", "sales_order_line_item_number", "region",
        F.array_join("reject_reason", ",").alias("reject_reason"),
    )


_SPEC = HistorySpec(
    keys=REVENUE.partition_cols, change_column="record_hash",
    date_keys=("order_create_calendar_date",),
)


def publish_two_extracts(spark, d, path):
    """Both extracts published to files, the second after the first."""
    schema = None
    for number, run in ((1, RUN_1), (2, RUN_2)):
        prepared = prepared_revenue(spark, d, run, number, f"revenue_{number}.csv")
        staged = sinks.stage_overwrite(prepared, f"{path}/curated")
        done = publish.publish_history(staged, path, _SPEC, run, f"batch_{number}", parts=8)
    return publish.read_published(spark, path, done.schema)


_CHANGED = " AND ".join(f"t.{k} = s.{k}" for k in _LOAD_KEYS.split(", "))
_PUBLISHED_SQL = f"""WITH {_CLEAN_SQL}, prepared AS (SELECT * REPLACE (CASE extract_no WHEN 1 THEN {T1} ELSE {T2} END AS batch_run_dt,
      CASE extract_no WHEN 1 THEN {T1} ELSE {T2} END AS create_dt, CASE extract_no WHEN 1 THEN {T1} ELSE {T2} END AS ingestion_ts,
      'revenue_' || extract_no || '.csv' AS source_file_name) FROM {_prepared_sql('extract_no, ', T1, chr(39) + chr(39))}),
    t AS (SELECT * EXCLUDE (extract_no) FROM prepared WHERE extract_no = 1), s AS (SELECT * EXCLUDE (extract_no) FROM prepared WHERE extract_no = 2),
    published AS (SELECT t.*, {T1} AS start_date, {OPEN} AS end_date, 'Y' AS is_current_fg, 1 AS version, {T1} AS last_update_dt
        FROM t LEFT JOIN s ON {_CHANGED} WHERE s.record_hash IS NULL OR s.record_hash = t.record_hash
      UNION ALL SELECT t.*, {T1}, {T2}, 'N', 1, {T2} FROM t JOIN s ON {_CHANGED} AND s.record_hash <> t.record_hash
      UNION ALL SELECT s.*, {T2}, {OPEN}, 'Y', CASE WHEN t.record_hash IS NULL THEN 1 ELSE 2 END, {T2}
        FROM s LEFT JOIN t ON {_CHANGED} WHERE t.record_hash IS NULL OR s.record_hash <> t.record_hash)"""


@query("entity_published", "J1 A7 A9 C25 M1", f"{_PUBLISHED_SQL} SELECT * FROM published")
def entity_published(spark, d):
    return publish_two_extracts(spark, d, scratch_path(spark, "published"))


@query(
    "entity_report", "F3 D8",
    f"""{_PUBLISHED_SQL} SELECT sap_order_key, CAST(sum("sum_of_cp_gross_revenue_(usd)") AS DECIMAL(38,15)) AS revenue FROM published
        WHERE is_current_fg = 'Y' GROUP BY sap_order_key""",
)
def entity_report(spark, d):
    published = publish_two_extracts(spark, d, scratch_path(spark, "reported"))
    return report_rollup(published, ["sap_order_key"], {"revenue": "sum_of_cp_gross_revenue_(usd)"})


# ---------------------------------------------------------------- rule-list entity

LISTED = EntityConfig.from_dict(
    {
        "required_column_list": ["order_id", "customer_id", "status", "price", "order_date", "modified", "priority"],
        "int_columns": ["order_id"],
        "notnull_columns": ["customer_id"],
        "date_columns": [{"order_date": "yyyy-MM-dd"}],
        "timestamp_columns": "[{'modified': 'yyyy-MM-dd HH:mm:ss'}]",
        "column_cleanup_columns": ["price"],
        "replace_zero_null": ["order_date"],
        "duplicate_policy": {"emea": "reject"},
    }
)
_LISTED_SQL = f"""WITH {DIRTY_ORDERS_SQL}, tidy AS (SELECT order_id, trim(customer_id) AS customer_id, status, substr(price, 2) AS price,
    CASE WHEN order_date IN ('0', 'Not available') THEN NULL ELSE order_date END AS order_date, modified, priority FROM dirty)"""
_LISTED_OK = (
    f"NOT ({BAD_INTEGER}) AND customer_id IS NOT NULL AND customer_id <> '' AND NOT ({BAD_DATE}) AND NOT coalesce({BAD_TIME}, false)"
)


@query(
    "listed_entity_load", "K13 K5 K1 K2 K3 K4 C20 C21",
    f"""{_LISTED_SQL} SELECT order_id, customer_id, status, price, CASE WHEN order_date <> '' THEN CAST(order_date AS DATE) END AS order_date,
        CAST(modified AS TIMESTAMP) AS modified, priority FROM tidy WHERE {_LISTED_OK}""",
)
def listed_entity_load(spark, d):
    return entity_load.check_entity(dirty_orders(spark, d), LISTED, region="EMEA").clean


@query(
    "listed_entity_counts", "F5 K11",
    f"""{_LISTED_SQL} SELECT count(*) AS landing_count, count(*) FILTER (WHERE {_LISTED_OK}) AS raw_count,
        count(*) FILTER (WHERE NOT ({_LISTED_OK})) AS reject_count FROM tidy""",
)
def listed_entity_counts(spark, d):
    return entity_load.check_entity(dirty_orders(spark, d), LISTED, region="EMEA").counts
