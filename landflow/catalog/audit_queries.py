"""Audit records and metrics, with events read as audit rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from landflow.catalog.base import DIRTY_ORDERS_SQL, query, table, utc
from landflow.catalog.rule_queries import _ANY_BAD, _checked
from landflow.operators import audit as A
from landflow.operators import rules as R
from landflow.streaming.micro_batch import hourly_metrics, incremental_filter

_AUDIT = [
    "CASE user_id % 3 WHEN 0 THEN 'AMS' WHEN 1 THEN 'APJ' ELSE 'WW' END AS regionname",
    "CAST(ts AS DATE) AS batchrundate",
    """CASE event_id % 4 WHEN 0 THEN 'FileValidation' WHEN 1 THEN 'DataValidation' WHEN 2 THEN 'CuratedLoad'
       ELSE 'PublishedLoad' END AS processname""",
    "concat('file_', CAST(user_id AS STRING)) AS filename",
    """CASE event_type WHEN 'view' THEN 'ReadyToExecute' WHEN 'click' THEN 'FileValidationFailed' WHEN 'signup' THEN 'InProgress'
       WHEN 'purchase' THEN 'Succeeded' ELSE 'Failed' END AS executionstatus""",
    "CAST(ts AS TIMESTAMP) AS executionendtime",
    "CAST(floor(value) AS BIGINT) AS executiondurationinseconds",
    "event_id % 1000 AS landingcount",
    "CASE WHEN event_type = 'error' THEN event_id % 1000 ELSE event_id % 7 END AS rejectcount",
    "CAST(floor(value * 10) AS BIGINT) AS datareadsize",
    "CAST(floor(value * 5) AS BIGINT) AS datawrittensize",
    "CAST(event_id AS STRING) AS pipelinerunid",
    "props AS destinationname",
]
_BATCH_SQL = "CASE WHEN regionname = 'WW' THEN 'WW_Batch_' ELSE regionname || 'Batch_' END || strftime(batchrundate, '%Y%m%d')"
AUDIT_SQL = f"log AS (SELECT {', '.join(_AUDIT)} FROM events), audit AS (SELECT *, {_BATCH_SQL} AS batchid FROM log)"


def audit_rows(spark, d):
    log = table(spark, d, "events").selectExpr(*_AUDIT)
    return log.withColumn("batchid", A.batch_id(F.col("regionname"), F.col("batchrundate")))


@query("batch_id", "L2", f"WITH {AUDIT_SQL} SELECT pipelinerunid, regionname, batchid FROM audit")
def batch_id(spark, d):
    return audit_rows(spark, d).select("pipelinerunid", "regionname", "batchid")


@query(
    "audit_latest_failed", "E6 F8",
    f"""WITH {AUDIT_SQL} SELECT processname, filename, executionstatus, executionendtime FROM (SELECT *,
        row_number() OVER (PARTITION BY processname, filename ORDER BY executionendtime DESC, CAST(pipelinerunid AS BIGINT) DESC) AS rn FROM audit
        WHERE processname IN ('CuratedLoad', 'PublishedLoad') AND batchrundate = DATE '2024-01-20' AND regionname = 'AMS')
        WHERE rn = 1 AND executionstatus = 'Failed'""",
)
def audit_latest_failed(spark, d):
    day = F.lit(dt.date(2024, 1, 20))
    today = audit_rows(spark, d).filter((F.col("batchrundate") == day) & (F.col("regionname") == "AMS"))
    numbered = today.withColumn("run_no", F.col("pipelinerunid").cast("bigint")).select(
        "processname", "filename", "executionstatus", "executionendtime", "run_no"
    )
    return A.latest_failed(
        numbered, ["CuratedLoad", "PublishedLoad"], tiebreak=["run_no"]
    ).drop("run_no")


@query(
    "audit_latest_status", "F8",
    f"""WITH {AUDIT_SQL} SELECT processname, filename, executionstatus, executionendtime, run_no FROM (SELECT *, CAST(pipelinerunid AS BIGINT) AS run_no,
        row_number() OVER (PARTITION BY processname, filename ORDER BY executionendtime DESC, CAST(pipelinerunid AS BIGINT) DESC) AS rn FROM audit)
        WHERE rn = 1""",
)
def audit_latest_status(spark, d):
    numbered = audit_rows(spark, d).select(
        "processname", "filename", "executionstatus", "executionendtime",
        F.col("pipelinerunid").cast("bigint").alias("run_no"),
    )
    return A.latest_per_group(numbered, ["processname", "filename"], ["executionendtime", "run_no"])


@query(
    "status_transition", "L3",
    f"""WITH {AUDIT_SQL}, v AS (SELECT batchid, filename, executionstatus, executionendtime, CAST(pipelinerunid AS BIGINT) AS run_no FROM audit
          WHERE processname = 'FileValidation'),
        u AS (SELECT batchid, filename, executionstatus, executionendtime, CAST(pipelinerunid AS BIGINT) AS run_no FROM audit
          WHERE processname <> 'FileValidation'),
        both_logs AS (SELECT *, 0 AS r FROM v UNION ALL SELECT *, 1 AS r FROM u),
        newest AS (SELECT *, row_number() OVER (PARTITION BY batchid, filename ORDER BY r DESC, executionendtime DESC, run_no DESC) AS rn FROM both_logs)
        SELECT batchid, filename, CASE WHEN EXISTS (SELECT 1 FROM v WHERE v.batchid = newest.batchid AND v.filename = newest.filename
          AND v.executionstatus = 'FileValidationFailed') THEN 'FileValidationFailed' ELSE executionstatus END AS executionstatus
        FROM newest WHERE rn = 1""",
)
def status_transition(spark, d):
    rows = audit_rows(spark, d).withColumn("run_no", F.col("pipelinerunid").cast("bigint"))
    return A.status_transition(
        rows.filter("processname = 'FileValidation'"),
        rows.filter("processname <> 'FileValidation'"),
        ["batchid", "filename"],
        ["executionendtime", "run_no"],
    )


@query(
    "ready_files", "H3",
    f"""WITH {AUDIT_SQL} SELECT filename, batchid, destinationname FROM audit WHERE batchrundate = DATE '2024-01-15'
        AND executionstatus = 'ReadyToExecute' AND processname = 'FileValidation' AND regionname = 'APJ'""",
)
def ready_files(spark, d):
    return A.ready_files(audit_rows(spark, d), dt.date(2024, 1, 15), "APJ")


@query(
    "process_metrics", "L4",
    f"""WITH {AUDIT_SQL} SELECT processname, batchrundate, count(*) AS runs, count(*) FILTER (WHERE executionstatus = 'Failed') AS failures,
        CAST(sum(executiondurationinseconds) AS BIGINT) AS duration_seconds, CAST(sum(datareadsize) AS BIGINT) AS read_bytes,
        CAST(sum(datawrittensize) AS BIGINT) AS written_bytes,
        CASE WHEN sum(landingcount) > 0 THEN CAST(round(sum(rejectcount)::DOUBLE / sum(landingcount), 6) AS DECIMAL(18,6)) END AS reject_rate
        FROM audit GROUP BY processname, batchrundate""",
)
def process_metrics(spark, d):
    return A.process_metrics(audit_rows(spark, d))


@query(
    "audit_record", "L1 F5",
    f"""WITH {DIRTY_ORDERS_SQL} SELECT 'WW_Batch_20240301' AS batchid, DATE '2024-03-01' AS batchrundate, 'WW' AS regionname,
        {', '.join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ('datapipelinename', 'pipelinerunid'))},
        'DataValidation' AS processname, 'orders.csv' AS filename,
        {', '.join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ('sourceplatform', 'targetplatform', 'activity', 'environment', 'interval', 'scriptpath'))},
        'Failed' AS executionstatus, 'Full File Rejected as we have ' || count(*) FILTER (WHERE {_ANY_BAD}) || ' rejection records' AS errormessage,
        CAST(NULL AS TIMESTAMP) AS executionstarttime, TIMESTAMP '2024-03-01 06:00:00' AS executionendtime,
        {', '.join(f"CAST(NULL AS BIGINT) AS {c}" for c in ('executiondurationinseconds', 'datareadsize', 'datawrittensize'))},
        count(*) AS landingcount, count(*) FILTER (WHERE NOT ({_ANY_BAD})) AS rawcount, count(*) FILTER (WHERE {_ANY_BAD}) AS rejectcount,
        {', '.join(f"CAST(NULL AS BIGINT) AS {c}" for c in ('previouscount', 'updatedcount', 'insertedcount'))},
        count(*) AS totalcount, TIMESTAMP '2024-03-01 06:00:00' AS logtimestamp,
        {', '.join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ('jobid', 'clusterid', 'sourcename', 'destinationname'))},
        {', '.join(f"CAST(NULL AS TIMESTAMP) AS {c}" for c in ('expected_start_time', 'expected_end_time'))},
        CAST(NULL AS VARCHAR) AS freshness, 'NRT' AS data_refresh_mode FROM dirty""",
)
def audit_record(spark, d):
    verdict = R.file_verdict(R.step_counts(_checked(spark, d)))
    run = F.lit(utc("2024-03-01 06:00:00"))
    return A.as_audit(
        verdict,
        {
            "batchid": A.batch_id("WW", run), "batchrundate": run, "regionname": F.lit("WW"),
            "processname": F.lit("DataValidation"), "filename": F.lit("orders.csv"),
            "executionendtime": run, "logtimestamp": run,
            "landingcount": F.col("landing_count"), "rawcount": F.col("raw_count"),
            "rejectcount": F.col("reject_count"),
            "totalcount": F.col("raw_count") + F.col("reject_count"),
            "data_refresh_mode": F.lit("NRT"),
        },
    )


@query(
    "hourly_metrics", "M5",
    """SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS arrivals, count(*) FILTER (WHERE value > 50) AS rejects
       FROM events GROUP BY 1, 2""",
)
def hourly(spark, d):
    return hourly_metrics(table(spark, d, "events"), "ts", F.col("value") > 50, ["event_type"])


@query(
    "incremental_filter", "M4",
    """SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_shipdate > (SELECT max(o_orderdate) FROM orders)""",
)
def incremental(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    target = table(spark, d, "orders").select(F.col("o_orderdate").alias("l_shipdate"))
    return incremental_filter(lines, target, "l_shipdate")
