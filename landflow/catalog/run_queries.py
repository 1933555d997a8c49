"""Whole runs of one configured entity: two extracts of the orders land, each is run."""

from __future__ import annotations

from pyspark.sql import functions as F

from landflow.catalog.base import RUN_1, RUN_2, query, table
from landflow.config import NO_CHECKS, EntityConfig
from landflow.plans import publish, run
from landflow.session import scratch_path
from landflow.sources import readers

_CONFIG = {
    "input_file_extension": "csv",
    "delimiter": "|",
    "column_type_map": {"id": "string", "status": "string", "day": "date", "price": "decimal(18,2)"},
    "dq_checks": {"trim_spaces": True, "null_notnull_check": True, "row_duplicate_check": True},
    "notnull_columns": ["id"],
    "primary_key_columns": ["id", "day"],
    "hash_columns": ["id", "day", "status", "price"],
    "curated_table": "curated/orders",
    "published_table": "published/orders",
}

#: The second extract has every third order, with another status for every sixth; some lines are unusable.
_TEXT = """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE CAST(o_orderkey AS STRING) END AS id,
    CASE WHEN n = 2 AND o_orderkey % 6 = 0 THEN 'X' ELSE o_orderstatus END AS status,
    CASE WHEN o_orderkey % 13 = 0 THEN 'no day' WHEN o_orderkey % 7 = 0 THEN ''
         ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS day,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS price
    FROM orders CROSS JOIN (SELECT {n} AS n) WHERE n = 1 OR o_orderkey % 3 = 0"""
_GOOD_SQL = """good AS (SELECT e.n, CAST(o_orderkey AS VARCHAR) AS id,
    CASE WHEN e.n = 2 AND o_orderkey % 6 = 0 THEN 'X' ELSE o_orderstatus END AS status,
    CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderdate AS DATE) END AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS price
    FROM orders, (VALUES (1), (2)) e(n) WHERE (e.n = 1 OR o_orderkey % 3 = 0) AND o_orderkey % 11 > 0 AND o_orderkey % 13 > 0)"""
_SHOWN = ["id", "status", "day", "price"]


def _run_both(spark, d, label, **more):
    root = scratch_path(spark, label)
    config = EntityConfig.from_dict(_CONFIG | more)
    for n, stamp in ((1, RUN_1), (2, RUN_2)):
        orders = table(spark, d, "orders")
        rows = spark.sql(_TEXT.replace("FROM orders", "FROM {orders}").format(n=n, orders="{orders}"), orders=orders)
        rows.select(*_SHOWN).write.option("sep", "|").option("header", True).csv(f"{root}/landing/{n}")
        run.run_entity(spark, f"{root}/landing/{n}", config, root, stamp, f"b{n}", "orders", parts=4)
    return root


@query(
    "configured_scd2", "J1 A13 K10 L1",
    f"""WITH {_GOOD_SQL}, first AS (SELECT * FROM good WHERE n = 1), second AS (SELECT * FROM good WHERE n = 2),
       paired AS (SELECT f.*, s.status IS NOT NULL AND s.status <> f.status AS changed FROM first f LEFT JOIN second s ON s.id = f.id)
       SELECT id, status, day, price, 1 AS version, CASE WHEN changed THEN 'N' ELSE 'Y' END AS is_current_fg FROM paired
       UNION ALL SELECT s.id, s.status, s.day, s.price, 2, 'Y' FROM second s JOIN paired p ON p.id = s.id AND p.changed""",
)
def configured_scd2(spark, d):
    root = _run_both(spark, d, "scd2")
    path = f"{root}/published/orders"
    return publish.read_published(spark, path, publish.stored_schema(spark, path)).select(*_SHOWN, "version", "is_current_fg")


@query(
    "configured_snapshot", "J5",
    f"WITH {_GOOD_SQL} SELECT id, status, day, price, CASE n WHEN 1 THEN DATE '2024-03-01' ELSE DATE '2024-03-02' END AS snapshot_date FROM good",
)
def configured_snapshot(spark, d):
    root = _run_both(spark, d, "snapshot", load_type="snapshot")
    return publish.read_published(spark, f"{root}/published/orders").select(*_SHOWN, "snapshot_date")


@query("configured_full", "J6", f"WITH {_GOOD_SQL} SELECT id, status, day, price FROM good WHERE n = 2")
def configured_full(spark, d):
    root = _run_both(spark, d, "full", load_type="full")
    path = f"{root}/published/orders"
    return publish.read_current(spark, path, publish.stored_schema(spark, path)).select(*_SHOWN)


@query(
    "configured_audit", "L1 F5",
    f"""WITH {_GOOD_SQL}, c AS (SELECT e.n, count(*) FILTER (WHERE e.n = 1 OR o_orderkey % 3 = 0) AS landed FROM orders, (VALUES (1), (2)) e(n) GROUP BY 1),
       g AS (SELECT n, count(*) AS kept, count(*) FILTER (WHERE n = 2 AND status = 'X') AS changed FROM good GROUP BY 1)
       SELECT 'b' || n AS batchid, 'LandingToRaw' AS processname, landed AS landingcount, kept AS rawcount, landed - kept AS rejectcount,
              NULL::BIGINT AS insertedcount, NULL::BIGINT AS updatedcount FROM c JOIN g USING (n)
       UNION ALL SELECT 'b' || n, 'RawToCurated', NULL, NULL, NULL, NULL, NULL FROM g
       UNION ALL SELECT 'b' || n, 'CuratedToPublished', NULL, NULL, 0, CASE n WHEN 1 THEN kept ELSE 0 END, changed FROM g""",
)
def configured_audit(spark, d):
    audit = run.audit_of(spark, _run_both(spark, d, "audited"))
    return audit.select("batchid", "processname", "landingcount", "rawcount", "rejectcount", "insertedcount", "updatedcount")


@query(
    "no_checks_guard", "K10",
    f"SELECT 'LandingToRaw' AS processname, 'Failed' AS executionstatus, '{NO_CHECKS}' AS errormessage, count(*) AS n FROM (SELECT 1 FROM orders LIMIT 1)",
)
def no_checks_guard(spark, d):
    """A configuration that checks nothing: the file is refused and the refusal recorded; nothing is published."""
    root = scratch_path(spark, "unchecked")
    table(spark, d, "orders").select("o_orderkey", "o_orderstatus").write.option("header", True).csv(f"{root}/landing")
    config = EntityConfig.from_dict({"required_column_list": ["id", "status"]})
    run.run_entity(spark, f"{root}/landing", config, root, RUN_1, "b1", "orders")
    found = run.audit_of(spark, root)
    return found.groupBy("processname", "executionstatus", "errormessage").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- files that are refused, whole or before they are read

_FILE_CONFIG = _CONFIG | {"column_type_map": {"id": "string", "status": "string", "price": "decimal(18,2)"}, "primary_key_columns": ["id"], "hash_columns": ["id", "status", "price"]}
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_FILE_NO = "(CAST(substr(o_orderpriority, 1, 1) AS INTEGER))"


def _land_files(spark, d, folder, swapped=False):
    """A file of orders for each priority, with its header; ids are blank for every tenth order of priority 1."""
    rows = table(spark, d, "orders").select(
        F.expr(_FILE_NO).alias("n"),
        F.when((F.col("o_orderkey") % 10 == 0) & F.col("o_orderpriority").startswith("1"), "").otherwise(F.col("o_orderkey").cast("string")).alias("id"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"),
    )
    names = ["price", "id", "status"] if swapped else ["id", "status", "price"]
    lines = rows.select("n", F.lit(1).alias("rank"), F.concat_ws("|", *names).alias("value")).unionByName(
        rows.select("n").distinct().select("n", F.lit(0).alias("rank"), F.lit("|".join(names)).alias("value"))
    )
    lines.repartition("n").sortWithinPartitions("n", "rank").select("n", "value").write.partitionBy("n").text(folder)


def _orders_sql(files, extra=""):
    return f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS price{extra} FROM orders
        WHERE {_FILE_NO} IN ({files})"""


@query("configured_file_verdict", "K11 I2 L1", f"""SELECT *, 1 AS failed_files FROM ({_orders_sql('2, 3, 4, 5')})""")
def configured_file_verdict(spark, d):
    """One of five files has records to reject: it is withheld whole, the others are published by the names in their headers."""
    root = scratch_path(spark, "file_verdict")
    _land_files(spark, d, f"{root}/landing", swapped=True)
    config = EntityConfig.from_dict(_FILE_CONFIG | {"reject_files": True})
    run.run_entity(spark, f"{root}/landing/*", config, root, RUN_1, "b1", "orders", parts=4)
    failed = run.audit_of(spark, root).where("processname = 'LandingToRaw' AND executionstatus = 'Failed'").count()
    return publish.read_published(spark, f"{root}/published/orders").select("id", "status", "price", F.lit(failed).alias("failed_files"))


def _by_folder(spark, path):
    """Numbered lines whose paths end in the folder's number: ``.../orders<n>_<time>.csv``, but for the fifth."""
    number = F.substring_index(F.substring_index("path", "/n=", -1), "/", 1)
    named = F.concat(F.lit("landing/orders"), number, F.when(number == "5", ".csv").otherwise("_20240301053000.csv"))
    return readers.numbered_lines(spark, path).withColumn("path", named)


@query(
    "configured_admission", "B1 B3 B6 B7 B9 B15 L1",
    f"""SELECT o.*, v.files FROM ({_orders_sql('1, 2')}) o, (SELECT 5 AS files) v WHERE o.id NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE {_FILE_NO} = 1 AND o_orderkey % 10 = 0)""",
)
def configured_admission(spark, d):
    """Five files: two are admitted, one has no manifest yet, one another size than declared, one another pattern."""
    root = scratch_path(spark, "admitted")
    _land_files(spark, d, f"{root}/landing")
    lines = _by_folder(spark, f"{root}/landing/*")
    sizes = lines.groupBy("path").agg(F.sum(F.length("value") + 1).alias("length"))
    listing = sizes.withColumn("modificationTime", F.lit(RUN_1))
    declared = F.when(F.col("path").contains("orders4"), F.col("length") + 1).otherwise(F.col("length"))
    manifest = sizes.where(~F.col("path").contains("orders3")).select(
        F.concat(F.lit("metadata_"), F.regexp_extract("path", "([^/]+)$", 1)).alias("manifest_name"), F.col("path").alias("listed_name"), declared.alias("declared_size")
    )
    config = EntityConfig.from_dict(_FILE_CONFIG | {"admission": True, "file_pattern": r"^orders[0-9]_[0-9]{14}\.csv$", "allowed_prefixes": ["orders"]})
    run.run_entity(spark, f"{root}/landing/*", config, root, RUN_1, "b1", "orders", parts=4, lines=lines, listing=listing, manifest=manifest)
    files = run.audit_of(spark, root).where("processname = 'FileValidation' AND sourcename <> 'orders'").count()
    return publish.read_published(spark, f"{root}/published/orders").select("id", "status", "price", F.lit(files).alias("files"))


_REPLAY_CONFIG = {
    "delimiter": "|", "column_type_map": {"id": "string", "kind": "string", "seen": "timestamp"}, "primary_key_columns": ["id"], "hash_columns": ["id", "kind"],
    "dq_checks": {"trim_spaces": True, "business_key_unique_check": True, "replay_check": True}, "watermark_column": "seen", "published_table": "published/events",
}


@query(
    "configured_key_and_replay", "K7 K9 L1",
    """SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 10 = 0 THEN 'business_key_not_unique' WHEN event_id % 2 = 0 THEN 'already_published' END AS reason FROM events
       WHERE event_id % 10 = 0 OR event_id % 2 = 0
       UNION ALL SELECT CAST(event_id AS VARCHAR), 'business_key_not_unique' FROM events WHERE event_id % 10 = 0""",
)
def configured_key_and_replay(spark, d):
    """Even events first, then all of them: the even ones are replayed, and every tenth comes twice with another kind."""
    root = scratch_path(spark, "replayed")
    rows = table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("seen"))
    twice = rows.where("id % 10 = 0").withColumn("kind", F.lit("again"))
    for n, part in ((1, rows.where("id % 2 = 0 AND id % 10 > 0")), (2, rows.unionAll(twice))):
        part.write.option("sep", "|").option("header", True).csv(f"{root}/landing/{n}")
        run.run_entity(spark, f"{root}/landing/{n}", EntityConfig.from_dict(_REPLAY_CONFIG), root, (RUN_1, RUN_2)[n - 1], f"b{n}", "events", parts=4)
    keyed = spark.read.parquet(f"{root}/rejects/events/batch=b2").select("id", F.col("reject_reason")[0].alias("reason"))
    return keyed.unionAll(spark.read.parquet(f"{root}/rejects/events_replayed/batch=b2").select("id", F.col("reject_reason")[0].alias("reason")))


@query(
    "run_tables", "A13 F5 L1",
    """SELECT t.name, count(*) AS landed, count(*) FILTER (WHERE t.name = 'orders~narrow' OR o_orderkey % 4 > 0) AS kept FROM orders,
       (VALUES ('orders~narrow'), ('orders~full')) t(name) GROUP BY 1""",
)
def run_tables(spark, d):
    """Two tables from one file, each by its own rules; the text is scanned once."""
    root = scratch_path(spark, "tables")
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderpriority")).alias("priority"), F.col("o_orderstatus").alias("status")
    )
    rows.write.option("header", True).csv(f"{root}/landing")
    base = {"dq_checks": {"trim_spaces": True, "null_notnull_check": True}, "load_type": "full", "unknown_columns": "drop"}
    tables = {
        "narrow": EntityConfig.from_dict(base | {"column_type_map": {"status": "string", "id": "string"}, "notnull_columns": ["id"]}),
        "full": EntityConfig.from_dict(base | {"column_type_map": {"id": "string", "status": "string", "priority": "string"}, "notnull_columns": ["priority"]}),
    }
    run.run_tables(spark, f"{root}/landing", tables, "orders", root, RUN_1, "b1")
    audit = run.audit_of(spark, root).where("processname = 'LandingToRaw'")
    return audit.select(F.col("sourcename").alias("name"), F.col("landingcount").alias("landed"), F.col("rawcount").alias("kept"))
