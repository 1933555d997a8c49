"""Merges, versions, history views, snapshots and the regional load.

The published side is the first extract of the order lines, the batch is the
second; together they are the whole table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from landflow.catalog.base import (
    LINE_EXTRACT, LINE_EXTRACT_SQL, LINE_KEYS, RUN_1, RUN_2, SPLIT_DAY, query, table, utc,
)
from landflow.catalog.cleaning_queries import CALENDAR_SQL, calendar
from landflow.functions.enrich import row_hash
from landflow.operators import history as H
from landflow.operators import joins, snapshot
from landflow.plans import regional

T1, T2 = "TIMESTAMP '2024-03-01 06:00:00'", "TIMESTAMP '2024-03-02 06:00:00'"
OPEN = "CAST(NULL AS TIMESTAMP)"
BUSINESS = ["order_id", "line_no", "return_flag", "line_status", "quantity", "price", "modified", "record_hash"]


def extract(spark, d, number: int):
    """All lines of one of the two extracts, repeats included."""
    lines = table(spark, d, "lineitem")
    day = F.lit(dt.date.fromisoformat(SPLIT_DAY))
    early = F.col("l_shipdate") < day
    rows = lines.filter(early if number == 1 else ~early).selectExpr(*LINE_EXTRACT)
    return rows.withColumn("record_hash", row_hash(["return_flag", "line_status"]))


HASH_SPEC = H.HistorySpec(keys=tuple(LINE_KEYS), change_column="record_hash")
TIME_SPEC = H.HistorySpec(keys=tuple(LINE_KEYS), change_column="modified")


def keyed_batch(spark, d, number: int):
    """One row per key: the latest of the extract, partitioned for the merge."""
    columns = ["return_flag", "line_status", "quantity", "price"]
    return H.one_per_key(extract(spark, d, number), HASH_SPEC, [F.col("modified").desc()], columns)


def batch(spark, d, number: int):
    return keyed_batch(spark, d, number).select(*BUSINESS)


VERSIONED = H.versioned_spec(LINE_KEYS, "record_hash")


def published(spark, d):
    """The first extract as a published table."""
    return H.first_load(batch(spark, d, 1), HASH_SPEC, RUN_1)



def _merge_sql(marker: str) -> str:
    b = ", ".join(f"t.{c}" for c in BUSINESS)
    n = ", ".join(f"s.{c}" for c in BUSINESS)
    on = "t.order_id = s.order_id AND t.line_no = s.line_no"
    return f"""WITH {LINE_EXTRACT_SQL}
      SELECT {b}, {T1} AS start_date, {OPEN} AS end_date, 'Y' AS is_current_fg, 1 AS version, {T1} AS last_update_dt
        FROM first_extract t LEFT JOIN second_extract s ON {on} WHERE s.order_id IS NULL OR s.{marker} = t.{marker}
      UNION ALL SELECT {b}, {T1}, {T2}, 'N', 1, {T2} FROM first_extract t JOIN second_extract s ON {on} AND s.{marker} <> t.{marker}
      UNION ALL SELECT {n}, {T2}, {OPEN}, 'Y', CASE WHEN t.order_id IS NULL THEN 1 ELSE 2 END, {T2}
        FROM second_extract s LEFT JOIN first_extract t ON {on} WHERE t.order_id IS NULL OR s.{marker} <> t.{marker}"""


@query("scd2_hash", "J1", _merge_sql("record_hash"))
def scd2_hash(spark, d):
    return H.merge_history(published(spark, d), keyed_batch(spark, d, 2), HASH_SPEC, RUN_2)


@query("scd2_watermark", "J2", _merge_sql("modified"))
def scd2_watermark(spark, d):
    current = H.first_load(batch(spark, d, 1), TIME_SPEC, RUN_1)
    return H.merge_history(current, keyed_batch(spark, d, 2), TIME_SPEC, RUN_2)


@query(
    "scd2_idempotent", "J1",
    f"""WITH merged AS ({_merge_sql('record_hash')}) SELECT order_id, line_no, record_hash, version, is_current_fg FROM merged
        WHERE is_current_fg = 'Y'""",
)
def scd2_idempotent(spark, d):
    """The second batch merged twice: nothing is closed the second time."""
    staging = keyed_batch(spark, d, 2)
    once, _ = H.split_merged(H.merge_history(published(spark, d), staging, HASH_SPEC, RUN_2), HASH_SPEC)
    twice = H.merge_history(once, staging, HASH_SPEC, utc("2024-03-03 06:00:00"))
    return twice.select("order_id", "line_no", "record_hash", "version", "is_current_fg")


_VERSIONED_SQL = f"""versions AS (SELECT * EXCLUDE (start_date, end_date, is_current_fg, last_update_dt), start_date AS effective_ts,
    end_date AS end_ts, is_current_fg = 'Y' AS is_active,
    CASE WHEN start_date = {T1} THEN 'lines_20240301060000.csv' ELSE 'lines_20240302060000.csv' END AS source_file
    FROM ({_merge_sql('record_hash')}))"""


def versions(spark, d):
    """All versions after both batches, with the file each came from."""
    first = batch(spark, d, 1).withColumn("source_file", F.lit("lines_20240301060000.csv"))
    second = keyed_batch(spark, d, 2).withColumn("source_file", F.lit("lines_20240302060000.csv"))
    return H.merge_history(H.first_load(first, VERSIONED, RUN_1), second, VERSIONED, RUN_2)


@query("scd2_versioned", "J4", f"WITH {_VERSIONED_SQL} SELECT * FROM versions")
def scd2_versioned(spark, d):
    return versions(spark, d)


@query(
    "as_of_view", "J7",
    f"WITH {_VERSIONED_SQL} SELECT * FROM versions WHERE effective_ts <= TIMESTAMP '2024-03-01 18:00:00' "
    "AND (end_ts IS NULL OR end_ts > TIMESTAMP '2024-03-01 18:00:00')",
)
def as_of_view(spark, d):
    return H.as_of_view(versions(spark, d), utc("2024-03-01 18:00:00"))


@query(
    "change_history", "J7",
    f"""WITH {_VERSIONED_SQL}, k AS (SELECT order_id, line_no, count(*) AS version_count FROM versions GROUP BY ALL HAVING count(*) > 1)
        SELECT versions.*, version_count, CAST(epoch(end_ts) - epoch(effective_ts) AS BIGINT) AS seconds_in_force FROM versions JOIN k USING (order_id, line_no)""",
)
def change_history(spark, d):
    return H.change_history(versions(spark, d), LINE_KEYS)


_BEFORE_2 = f"""SELECT * REPLACE ({OPEN} AS end_ts, true AS is_active) FROM versions WHERE effective_ts < {T2}"""


@query("rollback_to", "J8", f"WITH {_VERSIONED_SQL} {_BEFORE_2}")
def rollback_to(spark, d):
    return H.rollback_to(versions(spark, d), RUN_2, VERSIONED)


@query("rollback_before_file", "J8", f"WITH {_VERSIONED_SQL} {_BEFORE_2}")
def rollback_before_file(spark, d):
    return H.rollback_before_file(versions(spark, d), "lines_20240302060000.csv", VERSIONED)


# ---------------------------------------------------------------- batch against target

_EXTRACTS_SQL = f"""{LINE_EXTRACT_SQL}, target AS (SELECT *, 'Y' AS is_current_fg, nullif(return_flag, 'A') AS marker FROM first_extract),
    staging AS (SELECT * EXCLUDE (extract_no), nullif(return_flag, 'A') AS marker FROM extract WHERE extract_no = 2)"""
_ON = "t.order_id = s.order_id AND t.line_no = s.line_no"


#: A change marker that is null for some rows of either side.
_MARKER = "nullif(return_flag, 'A')"


def _target(spark, d):
    return batch(spark, d, 1).withColumns({"is_current_fg": F.lit("Y"), "marker": F.expr(_MARKER)})


def _batch_2(spark, d):
    return extract(spark, d, 2).withColumn("marker", F.expr(_MARKER))


@query(
    "expire_join", "E1",
    f"WITH {_EXTRACTS_SQL} SELECT * FROM target t WHERE EXISTS (SELECT 1 FROM staging s WHERE {_ON} AND s.marker IS DISTINCT FROM t.marker)",
)
def expire_join(spark, d):
    return joins.expire_join(_target(spark, d), _batch_2(spark, d), LINE_KEYS, "marker")


@query(
    "insert_left_join", "E2",
    f"WITH {_EXTRACTS_SQL} SELECT s.* FROM staging s LEFT JOIN target t ON {_ON} WHERE t.order_id IS NULL OR t.marker IS DISTINCT FROM s.marker",
)
def insert_left_join(spark, d):
    return joins.insert_left_join(_batch_2(spark, d), _target(spark, d), LINE_KEYS, "marker")


@query(
    "insert_not_exists", "E3",
    f"WITH {_EXTRACTS_SQL} SELECT * FROM staging s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE {_ON} AND t.marker IS NOT DISTINCT FROM s.marker)",
)
def insert_not_exists(spark, d):
    return joins.insert_not_exists(_batch_2(spark, d), _target(spark, d), LINE_KEYS, "marker")


_EVENT_KEYS_SQL = """batch AS (SELECT user_id, date_trunc('hour', ts) AS hour, event_type, value FROM events),
    seen AS (SELECT DISTINCT user_id, date_trunc('hour', ts) AS hour, event_type FROM events WHERE event_type IN ('click', 'view'))"""


def _replay(spark, d, keep):
    rows = table(spark, d, "events").select(
        "user_id", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"), "event_type", "value"
    )
    target = rows.filter(F.col("event_type").isin("click", "view"))
    return joins.replay_join(rows, target, ["user_id"], "hour", "event_type", keep)


@query("replay_join", "E5 K9", f"WITH {_EVENT_KEYS_SQL} SELECT * FROM batch SEMI JOIN seen USING (user_id, hour, event_type)")
def replay_join(spark, d):
    return _replay(spark, d, "replayed")


@query("replay_fresh", "E5 K9", f"WITH {_EVENT_KEYS_SQL} SELECT * FROM batch ANTI JOIN seen USING (user_id, hour, event_type)")
def replay_fresh(spark, d):
    return _replay(spark, d, "fresh")


@query(
    "hash_verify", "E7",
    """SELECT o_orderkey, CASE WHEN o_custkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS status FROM orders WHERE o_custkey % 7 = 0""",
)
def hash_verify(spark, d):
    df = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"),
        row_hash(["o_orderkey", "o_orderstatus"]).alias("record_hash"),
    )
    tampered = df.withColumn("status", F.when(F.col("o_custkey") % 7 == 0, "X").otherwise(F.col("status")))
    return joins.hash_verify(tampered, "record_hash", ["o_orderkey", "status"]).select("o_orderkey", "status")


# ---------------------------------------------------------------- versions

_EVENT_ORDER = "PARTITION BY user_id ORDER BY ts, event_id"


def _events(spark, d):
    return table(spark, d, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))


_DAY = "to_date(ts)"


@query("version_number", "G2", f"SELECT user_id, event_id, ts, CAST(row_number() OVER ({_EVENT_ORDER}) AS INTEGER) AS version FROM events")
def version_number(spark, d):
    return H.version_number(_events(spark, d), ["user_id"], "ts", ["event_id"])


@query("interval_end", "G3", f"SELECT user_id, event_id, ts, lead(ts) OVER ({_EVENT_ORDER}) AS end_ts FROM events")
def interval_end(spark, d):
    return H.interval_end(_events(spark, d), ["user_id"], "ts", ["event_id"], F.expr(_DAY))


@query(
    "next_version", "F7",
    f"""WITH {LINE_EXTRACT_SQL}, last AS (SELECT order_id, line_no, max(v) AS v FROM (SELECT order_id, line_no,
          row_number() OVER (PARTITION BY order_id, line_no ORDER BY modified) AS v FROM extract WHERE extract_no = 1) GROUP BY ALL)
        SELECT s.*, CAST(coalesce(v, 0) + 1 AS INTEGER) AS version FROM second_extract s LEFT JOIN last USING (order_id, line_no)""",
)
def next_version(spark, d):
    numbered = H.version_number(
        extract(spark, d, 1), LINE_KEYS, "modified", ["record_hash"], F.expr("year(modified)")
    )
    return H.next_version(batch(spark, d, 2), numbered, LINE_KEYS)


# ---------------------------------------------------------------- insert columns and ids


@query(
    "column_defaults", "J10",
    f"""WITH {LINE_EXTRACT_SQL} SELECT order_id, line_no, return_flag, line_status, record_hash, {T2} AS start_date, {OPEN} AS end_date,
        'Y' AS is_current_fg, {T2} AS batch_run_dt, 'loader' AS created_by, {T2} AS create_dt, {T2} AS last_update_dt,
        'landing' AS source_nm, 'lines.csv' AS source_file_name FROM (SELECT * FROM first_extract UNION ALL SELECT * FROM second_extract)""",
)
def column_defaults(spark, d):
    staging = batch(spark, d, 1).unionByName(batch(spark, d, 2)).withColumn("source_file_name", F.lit("lines.csv"))
    return H.column_defaults(
        staging, LINE_KEYS, ["row_id", "return_flag", "line_status", "line_no"],
        H.scd2_defaults(RUN_2, "loader", "landing"), surrogate="row_id",
    )


_ID_SQL = "row_number() OVER (ORDER BY md5(concat_ws('|', order_id, line_no)), order_id, line_no)"


@query(
    "surrogate_id", "J9",
    f"""WITH {LINE_EXTRACT_SQL}, fresh AS (SELECT order_id, line_no FROM second_extract ANTI JOIN first_extract USING (order_id, line_no)),
        stored AS (SELECT {_ID_SQL} + 999 AS row_id, order_id, line_no FROM first_extract)
        SELECT * FROM stored UNION ALL
        SELECT {_ID_SQL} + (SELECT max(row_id) FROM stored), order_id, line_no FROM fresh""",
)
def surrogate_id(spark, d):
    """Both extracts: the first is numbered from 1000, new keys of the second go on after its largest id."""
    stored = H.surrogate_id(batch(spark, d, 1).select(*LINE_KEYS), LINE_KEYS, "row_id", start=1000)
    fresh = batch(spark, d, 2).select(*LINE_KEYS).join(stored, LINE_KEYS, "left_anti")
    return stored.unionByName(H.surrogate_id_after(fresh, stored, LINE_KEYS, "row_id"))


# ---------------------------------------------------------------- snapshots

_MONTH_ROWS = "SELECT o_orderkey, o_orderstatus, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date FROM orders"


@query(
    "latest_snapshot", "J5",
    f"WITH s AS ({_MONTH_ROWS}) SELECT *, CASE WHEN snapshot_date = (SELECT max(snapshot_date) FROM s) THEN 'Y' ELSE 'N' END AS is_latest_fg FROM s",
)
def latest_snapshot(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("snapshot_date")
    )
    return snapshot.latest_snapshot(rows)


@query(
    "snapshot_flip", "J5",
    f"""WITH {LINE_EXTRACT_SQL} SELECT *, 'N' AS active_flag FROM first_extract UNION ALL SELECT *, 'Y' FROM second_extract""",
)
def snapshot_flip(spark, d):
    before = batch(spark, d, 1).withColumn("active_flag", F.lit("Y"))
    return snapshot.snapshot_flip(before, batch(spark, d, 2))


@query("full_load", "J6", f"WITH {LINE_EXTRACT_SQL} SELECT * FROM second_extract")
def full_load(spark, d):
    return snapshot.full_load(batch(spark, d, 1), batch(spark, d, 2))


# ---------------------------------------------------------------- regional load

# Column names of the regional table.
_CURATED = [
    """CASE l_returnflag WHEN 'R' THEN 'REV' WHEN 'A' THEN 'BACKLOG' ELSE 'SNI' END AS cp_backlog_sni_revenue""",
    "o_orderpriority AS order_type",
    "CAST(CAST(o_orderdate AS DATE) AS STRING) AS order_create_date",
    """CASE WHEN l_linenumber = 7 THEN concat('Grand Total ', CAST(l_orderkey AS STRING))
       ELSE lpad(CAST(l_orderkey AS STRING), 10, '0') END AS sales_order_identifier""",
    """CASE WHEN l_suppkey % 50 = 1 THEN concat(CAST(l_linenumber AS STRING), '?')
       ELSE lpad(CAST(l_linenumber AS STRING), 6, '0') END AS sales_order_line_item_identifier""",
    "l_linestatus AS source_type",
    "CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS delivery_identifier",
    """CASE r_name WHEN 'AMERICA' THEN 'Americas' WHEN 'ASIA' THEN 'Asia Pacific ' WHEN 'AFRICA' THEN 'Elsewhere'
       ELSE 'EMEA' END AS segment""",
    "CAST(NULL AS STRING) AS shipment_date",
    "CAST(l_quantity AS DECIMAL(18,2)) AS sum_of_sales_order_base_quantity",
    "CAST(l_extendedprice AS DECIMAL(18,2)) AS eg_net_revenue",
    "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(0.08 AS DECIMAL(18,2)) - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(28,4)) AS secured_position_net_usd",
    "CAST(l_shipdate AS TIMESTAMP) AS process_timestamp",
    "CAST(o_orderdate AS DATE) AS batch_run_dt",
]
_CURATED_COLUMNS = [text.rsplit(" AS ", 1)[1] for text in _CURATED]


def curated(spark, d, number: int):
    day = F.lit(dt.date.fromisoformat(SPLIT_DAY))
    early = F.col("l_shipdate") < day
    return (
        table(spark, d, "lineitem").filter(early if number == 1 else ~early)
        .join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(*_CURATED)
    )


# Its key columns.
_REGION_KEYS = (
    "order_type, order_create_date, sales_order_identifier, sales_order_line_item_identifier, source_type, "
    "shipment_date, delivery_identifier, segment"
)
_REST = ", ".join(c for c in _CURATED_COLUMNS if c not in _REGION_KEYS)
_REST_ORDER = ", ".join(f"{c} NULLS FIRST" for c in _CURATED_COLUMNS if c not in _REGION_KEYS)
_REGION_SQL = f"""curated AS (SELECT {', '.join(_CURATED)}, CASE WHEN l_shipdate < DATE '{SPLIT_DAY}' THEN 1 ELSE 2 END AS extract_no
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
  stripped AS (SELECT * REPLACE (ltrim(sales_order_identifier, '0') AS sales_order_identifier,
    ltrim(sales_order_line_item_identifier, '0') AS sales_order_line_item_identifier) FROM curated),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY extract_no, {_REGION_KEYS} ORDER BY
    CASE cp_backlog_sni_revenue WHEN 'REV' THEN 1 WHEN 'BACKLOG' THEN 2 ELSE 3 END,
    CASE WHEN sum_of_sales_order_base_quantity <> 0 AND eg_net_revenue <> 0 THEN 1
         WHEN sum_of_sales_order_base_quantity = 0 AND eg_net_revenue <> 0 THEN 2 ELSE 3 END, {_REST_ORDER}) AS rn FROM stripped),
  {CALENDAR_SQL},
  admitted AS (SELECT ranked.* EXCLUDE (rn), CASE trim(segment) WHEN 'Americas' THEN 'AMS' WHEN 'Asia Pacific' THEN 'APJ' ELSE 'EMEA' END AS region,
    CASE trim(segment) WHEN 'Americas' THEN 503 WHEN 'Asia Pacific' THEN 502 ELSE 500 END AS region_id,
    fiscal_year_quarter || right(fiscal_year, 2) AS fiscal_quarter,
    sales_order_identifier || '-' || sales_order_line_item_identifier AS sap_order_key
    FROM ranked LEFT JOIN calendar ON batch_run_dt = calendar."date"
    WHERE rn = 1 AND trim(segment) IN ('Americas', 'Asia Pacific', 'EMEA') AND (trim(segment) = 'EMEA' OR secured_position_net_usd >= 0)
    AND sales_order_identifier NOT LIKE '%Grand%' AND sales_order_line_item_identifier NOT LIKE '%?%' AND sales_order_identifier NOT LIKE '%?%'),
  t AS (SELECT * EXCLUDE (extract_no) FROM admitted WHERE extract_no = 1),
  s AS (SELECT * EXCLUDE (extract_no) FROM admitted WHERE extract_no = 2)"""
_SAME_KEY = " AND ".join(
    f"coalesce(trim(t.{k}), '') = coalesce(trim(s.{k}), '')" for k in _REGION_KEYS.split(", ")
)
_REGION_MERGE = f"""merged AS (
    SELECT t.*, {T1} AS start_date, {OPEN} AS end_date, 'Y' AS is_current_fg, {T1} AS last_update_dt FROM t WHERE NOT EXISTS
      (SELECT 1 FROM s WHERE {_SAME_KEY} AND s.process_timestamp <> t.process_timestamp)
    UNION ALL SELECT t.*, {T1}, {T2}, 'N', {T2} FROM t WHERE EXISTS
      (SELECT 1 FROM s WHERE {_SAME_KEY} AND s.process_timestamp <> t.process_timestamp)
    UNION ALL SELECT s.*, {T2}, {OPEN}, 'Y', {T2} FROM s WHERE NOT EXISTS
      (SELECT 1 FROM t WHERE {_SAME_KEY} AND s.process_timestamp = t.process_timestamp))"""


def regional_published(spark, d):
    spec = regional.RegionalSpec()
    days = calendar(spark, d)
    first = regional.regional_batch(curated(spark, d, 1), days, spec)
    second = regional.regional_batch(curated(spark, d, 2), days, spec)
    current = H.first_load(first, spec.history, RUN_1)
    return regional.regional_merge(current, second, RUN_2, spec)


@query("scd2_regional", "J3 G1 D4 D5 D6 J2 E4 C24 C26 C27", f"WITH {_REGION_SQL}, {_REGION_MERGE} SELECT * FROM merged")
def scd2_regional(spark, d):
    return regional_published(spark, d)


@query(
    "regional_report", "F3 D8 J3",
    f"""WITH {_REGION_SQL}, {_REGION_MERGE} SELECT region, sap_order_key, CAST(sum(secured_position_net_usd) AS DECIMAL(38,4)) AS secured_position,
        CAST(sum(eg_net_revenue) AS DECIMAL(28,2)) AS eg_revenue FROM merged WHERE is_current_fg = 'Y' GROUP BY region, sap_order_key""",
)
def regional_report(spark, d):
    return regional.regional_report(regional_published(spark, d))
