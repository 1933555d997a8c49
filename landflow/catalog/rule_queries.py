"""Row rules, rejects, verdicts and order classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from landflow.catalog.base import DIRTY_ORDERS_SQL, dirty_orders, query, table, utc
from landflow.operators import classify
from landflow.operators import duplicates as D
from landflow.operators import rules as R

RECORD = ["order_id", "customer_id", "status", "price", "order_date", "modified", "priority"]


def _failing(spark, d, rules):
    """Failing rows with their reasons as text."""
    failed = R.failed(R.apply_rules(dirty_orders(spark, d), rules))
    return failed.withColumns(
        {c: F.array_join(c, ",") for c in ("reject_reason", "rejected_column")}
    )


def _failing_sql(condition: str, reason: str, column: str) -> str:
    return (
        f"WITH {DIRTY_ORDERS_SQL} SELECT *, '{reason}' AS reject_reason, '{column}' AS rejected_column "
        f"FROM dirty WHERE {condition}"
    )


BAD_INTEGER = "order_id IS NULL OR NOT regexp_matches(order_id, '^[0-9]+$')"
BAD_NULL = "customer_id IS NULL OR trim(customer_id) = ''"
BAD_DATE = (
    "(order_date IS NOT NULL AND trim(order_date) <> '' "
    "AND NOT regexp_matches(order_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$'))"
)
BAD_TIME = "(modified IS NOT NULL AND modified = 'bad time')"


@query(
    "integer_rule", "K1",
    _failing_sql(BAD_INTEGER, "order_id_integer_format_incorrect", "order_id"),
)
def integer_rule(spark, d):
    return _failing(spark, d, [R.integer_rule("order_id")])


@query("notnull_rule", "K2", _failing_sql(BAD_NULL, "customer_id_null_check_failed", "customer_id"))
def notnull_rule(spark, d):
    return _failing(spark, d, [R.notnull_rule("customer_id")])


@query("date_rule", "K3", _failing_sql(BAD_DATE, "order_date_date_format_incorrect", "order_date"))
def date_rule(spark, d):
    return _failing(spark, d, [R.date_rule("order_date", "yyyy-MM-dd")])


@query("timestamp_rule", "K4", _failing_sql(BAD_TIME, "modified_timestamp_format_incorrect", "modified"))
def timestamp_rule(spark, d):
    return _failing(spark, d, [R.timestamp_rule("modified", "yyyy-MM-dd HH:mm:ss")])


def all_rules():
    return [
        R.integer_rule("order_id"),
        R.notnull_rule("customer_id"),
        R.notnull_rule("status"),
        R.date_rule("order_date", "yyyy-MM-dd"),
        R.timestamp_rule("modified", "yyyy-MM-dd HH:mm:ss"),
    ]


#: (condition, reason, column) in the order of the sorted reason texts
ALL_RULES_SQL = [
    (BAD_NULL, "customer_id_null_check_failed", "customer_id"),
    (BAD_TIME, "modified_timestamp_format_incorrect", "modified"),
    (BAD_DATE, "order_date_date_format_incorrect", "order_date"),
    (BAD_INTEGER, "order_id_integer_format_incorrect", "order_id"),
    ("status IS NULL OR trim(status) = ''", "status_null_check_failed", "status"),
]
_ANY_BAD = " OR ".join(f"({c})" for c, _, _ in ALL_RULES_SQL)
_REASONS = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{r}' END" for c, r, _ in ALL_RULES_SQL) + ")"
_COLUMNS = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for c, _, n in ALL_RULES_SQL) + ")"
_LONG = " UNION ALL ".join(
    f"SELECT *, '{r}' AS reject_reason, '{n}' AS rejected_column FROM dirty WHERE {c}"
    for c, r, n in ALL_RULES_SQL
)


def _checked(spark, d):
    return R.apply_rules(dirty_orders(spark, d), all_rules())


@query(
    "row_verdict", "K12",
    f"WITH {DIRTY_ORDERS_SQL} SELECT *, {_REASONS} AS reject_reason, {_COLUMNS} AS rejected_column FROM dirty WHERE {_ANY_BAD}",
)
def row_verdict(spark, d):
    return _failing(spark, d, all_rules())


@query("union_rejects", "I1 C34", f"WITH {DIRTY_ORDERS_SQL} {_LONG}")
def union_rejects(spark, d):
    return R.union_rejects(_checked(spark, d))


@query(
    "reject_summary", "F4",
    f"""WITH {DIRTY_ORDERS_SQL}, narrow AS (SELECT status, order_date, reject_reason, rejected_column, count(*) AS n
            FROM ({_LONG}) GROUP BY ALL)
        SELECT status, order_date, string_agg(reject_reason, ',' ORDER BY reject_reason) AS reject_reason,
          string_agg(rejected_column, ',' ORDER BY reject_reason) AS rejected_column,
          string_agg(CAST(n AS VARCHAR), ',' ORDER BY reject_reason) AS occurrences FROM narrow GROUP BY status, order_date""",
)
def reject_summary(spark, d):
    narrow = R.union_rejects(_checked(spark, d)).select(
        "status", "order_date", "reject_reason", "rejected_column"
    )
    summary = R.reject_summary(narrow)
    texts = {c: F.array_join(c, ",") for c in ("reject_reason", "rejected_column")}
    texts["occurrences"] = F.array_join(F.col("occurrences").cast("array<string>"), ",")
    return summary.withColumns(texts)


@query(
    "reject_sample", "H1",
    f"WITH {DIRTY_ORDERS_SQL} SELECT * FROM ({_LONG}) ORDER BY reject_reason, customer_id NULLS FIRST, order_id NULLS FIRST, price, modified NULLS FIRST LIMIT 5",
)
def reject_sample(spark, d):
    order = ["reject_reason", "customer_id", "order_id", "price", "modified"]
    return R.reject_sample(R.union_rejects(_checked(spark, d)), order)


@query(
    "minus_rejected", "I2",
    f"""WITH {DIRTY_ORDERS_SQL}, narrow AS (SELECT status, order_date, priority FROM dirty),
        bad AS (SELECT DISTINCT status, order_date, priority FROM dirty WHERE {_ANY_BAD})
        SELECT * FROM narrow EXCEPT ALL SELECT * FROM bad""",
)
def minus_rejected(spark, d):
    names = ["status", "order_date", "priority"]
    rejected = R.failed(_checked(spark, d)).select(*names)
    return D.minus_all(dirty_orders(spark, d).select(*names), D.drop_duplicates(rejected))


@query(
    "step_counts", "F5",
    f"""WITH {DIRTY_ORDERS_SQL} SELECT priority, count(*) AS landing_count,
          count(*) FILTER (WHERE NOT ({_ANY_BAD})) AS raw_count, count(*) FILTER (WHERE {_ANY_BAD}) AS reject_count
        FROM dirty GROUP BY priority""",
)
def step_counts(spark, d):
    return R.step_counts(_checked(spark, d), ["priority"])


#: Orders of one customer segment form one landed file.
_BY_FILE = """by_file AS (SELECT c_mktsegment AS file_name, CASE WHEN c_mktsegment = 'HOUSEHOLD' AND o_orderkey % 97 = 0
      THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS order_id, CASE WHEN c_mktsegment = 'BUILDING' AND o_custkey % 5 = 0
      THEN ' ' ELSE o_orderstatus END AS status FROM orders JOIN customer ON o_custkey = c_custkey)"""


def _by_file(spark, d):
    joined = table(spark, d, "orders").join(
        table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    rows = joined.selectExpr(
        "c_mktsegment AS file_name",
        """CASE WHEN c_mktsegment = 'HOUSEHOLD' AND o_orderkey % 97 = 0 THEN NULL
           ELSE CAST(o_orderkey AS STRING) END AS order_id""",
        "CASE WHEN c_mktsegment = 'BUILDING' AND o_custkey % 5 = 0 THEN ' ' ELSE o_orderstatus END AS status",
    )
    return R.apply_rules(rows, [R.integer_rule("order_id"), R.notnull_rule("status")])


_FILE_COUNTS = """counts AS (SELECT file_name, count(*) AS landing_count,
      count(*) FILTER (WHERE order_id IS NOT NULL AND trim(status) <> '') AS raw_count,
      count(*) FILTER (WHERE order_id IS NULL OR trim(status) = '') AS reject_count FROM by_file GROUP BY file_name)"""


@query(
    "file_verdict", "K11",
    f"""WITH {_BY_FILE}, {_FILE_COUNTS} SELECT *, CASE WHEN reject_count > 0 THEN 'Failed' ELSE 'Succeeded' END AS executionstatus,
        CASE WHEN reject_count > 0 THEN 'Full File Rejected as we have ' || reject_count || ' rejection records' ELSE '' END AS errormessage
        FROM counts""",
)
def file_verdict(spark, d):
    return R.file_verdict(R.step_counts(_by_file(spark, d), ["file_name"]))


@query(
    "withhold_failed_files", "K11 I2",
    f"""WITH {_BY_FILE}, {_FILE_COUNTS} SELECT file_name, order_id, status FROM by_file
        WHERE file_name IN (SELECT file_name FROM counts WHERE reject_count = 0)""",
)
def withhold_failed_files(spark, d):
    checked = _by_file(spark, d)
    verdicts = R.file_verdict(R.step_counts(checked, ["file_name"]))
    return R.withhold_failed_files(checked, verdicts, "file_name")


@query(
    "watermark_bounds", "K6 M3",
    """SELECT event_id, 'ts_watermark_out_of_bounds' AS reject_reason FROM events
       WHERE event_type = 'error' OR ts < TIMESTAMP '2024-01-05 00:00:00' OR ts > TIMESTAMP '2024-01-28 00:00:00'""",
)
def watermark_bounds(spark, d):
    df = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("ts")
    )
    rule = R.watermark_rule("ts", utc("2024-01-05 00:00:00"), utc("2024-01-28 00:00:00"))
    failed = R.failed(R.apply_rules(df, [rule]))
    return failed.select("event_id", F.array_join("reject_reason", ",").alias("reject_reason"))


@query(
    "hash_rule", "K8",
    """SELECT o_orderkey, 'record_hash_hash_mismatch' AS reject_reason FROM orders
       WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW'""",
)
def hash_rule(spark, d):
    from landflow.functions.enrich import row_hash

    stored = F.when(F.col("o_orderpriority") != "5-LOW", row_hash(["o_orderkey", "o_orderstatus"]))
    tampered = F.when(F.col("o_orderstatus") == "P", "X").otherwise(F.col("o_orderstatus"))
    df = table(spark, d, "orders").withColumn("record_hash", stored).withColumn("o_orderstatus", tampered)
    failed = R.failed(
        R.apply_rules(df, [R.hash_rule("record_hash", ["o_orderkey", "o_orderstatus"])])
    )
    return failed.select("o_orderkey", F.array_join("reject_reason", ",").alias("reject_reason"))


# ---------------------------------------------------------------- order classes

_ORDER_LINES = [
    "o_orderkey",
    """CASE o_orderpriority WHEN '1-URGENT' THEN 'ZOR' WHEN '2-HIGH' THEN 'ZCR' WHEN '3-MEDIUM' THEN 'ZRE'
       WHEN '4-NOT SPECIFIED' THEN 'ZDR' ELSE 'ZTP' END AS order_type""",
    """CASE o_custkey % 12 WHEN 0 THEN '4RN' WHEN 1 THEN '106' WHEN 2 THEN 'B13' WHEN 3 THEN '410' WHEN 4 THEN 'C32'
       WHEN 5 THEN '305' WHEN 6 THEN '1CC' WHEN 7 THEN '4CT' WHEN 8 THEN '050' WHEN 9 THEN 'I55'
       WHEN 10 THEN '313' END AS reason""",
    "o_orderstatus AS origin",
]
_LINES_SQL = "lines AS (SELECT " + ", ".join(_ORDER_LINES) + " FROM orders)"
# what the decision tables say about the types and reasons above
_CLASS_SQL = {
    "APJ": (
        "order_type = 'ZOR'",
        """(order_type = 'ZCR' AND reason IN ('4RN', '1CC', '4CT', '305')) OR (order_type = 'ZDR' AND reason IN ('313', '1CC', '4CT'))
           OR (order_type = 'ZRE' AND reason IN ('305', '4CT')) OR (order_type = 'ZTP' AND reason IN ('I55', '4CT', '4RN'))""",
    ),
    "AMS": (
        "order_type IN ('ZOR', 'ZDR')",
        "(order_type = 'ZCR' AND reason IN ('B13', '305', '050')) OR (order_type = 'ZRE' AND reason IN ('305', '050'))",
    ),
    "EMEA": (
        "order_type = 'ZOR' OR (order_type = 'ZDR' AND reason = '106')",
        """(order_type = 'ZRE' AND reason = '410') OR (order_type = 'ZCR' AND reason IN ('C32', '050', '410'))
           OR (order_type = 'ZDR' AND reason IN ('050', '410', 'C32'))""",
    ),
}


def _class_case(region: str) -> str:
    actual, returned = _CLASS_SQL[region]
    return f"CASE WHEN {actual} THEN 'actual' WHEN {returned} THEN 'return' ELSE 'unclassified' END"


def _classified(spark, d, region):
    lines = table(spark, d, "orders").selectExpr(*_ORDER_LINES)
    cls = classify.order_class(region, F.col("order_type"), F.col("reason"))
    return lines.withColumn("order_class", cls)


@query(
    "order_class", "D7",
    f"WITH {_LINES_SQL} SELECT *, {_class_case('APJ')} AS apj, {_class_case('AMS')} AS ams, {_class_case('EMEA')} AS emea FROM lines",
)
def order_class(spark, d):
    t, r = F.col("order_type"), F.col("reason")
    return table(spark, d, "orders").selectExpr(*_ORDER_LINES).withColumns(
        {region.lower(): classify.order_class(region, t, r) for region in ("APJ", "AMS", "EMEA")}
    )


@query(
    "class_reconcile", "F6",
    f"""WITH {_LINES_SQL} SELECT count(*) AS raw_count, count(*) FILTER (WHERE c = 'actual') AS actual_count,
        count(*) FILTER (WHERE c = 'return') AS return_count, count(*) = count(*) FILTER (WHERE c <> 'unclassified') AS reconciled
        FROM (SELECT {_class_case('AMS')} AS c FROM lines)""",
)
def class_reconcile(spark, d):
    return classify.class_reconcile(_classified(spark, d, "AMS"))


@query(
    "unclassified_rows", "I5",
    f"WITH {_LINES_SQL} SELECT *, 'unclassified' AS order_class FROM lines WHERE {_class_case('EMEA')} = 'unclassified'",
)
def unclassified_rows(spark, d):
    return classify.unclassified_rows(_classified(spark, d, "EMEA"))


@query(
    "unclassified_difference", "I5",
    f"""WITH {_LINES_SQL}, c AS (SELECT order_type, reason, {_class_case('APJ')} AS order_class FROM lines)
        SELECT * FROM c EXCEPT ALL SELECT * FROM c WHERE order_class <> 'unclassified'""",
)
def unclassified_difference(spark, d):
    narrow = _classified(spark, d, "APJ").select("order_type", "reason", "order_class")
    return classify.unclassified_by_difference(narrow)
