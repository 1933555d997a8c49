"""Round trips through files: tables are written the way files land, then read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from landflow.catalog.base import DIRTY_ORDERS_SQL, RUN_1, dirty_orders, query, table
from landflow.catalog.rule_queries import RECORD, _ANY_BAD, _REASONS, _checked
from landflow.config import EntityConfig
from landflow.operators import audit as A
from landflow.operators import rules as R
from landflow.operators.admission import MANIFEST_PREFIX, admission_verdict, split_listing
from landflow.plans import entity_load
from landflow.session import scratch_path
from landflow.sources import readers, sinks

_TEXT = ["CAST(o_orderkey AS STRING) AS id", "o_orderpriority AS priority", "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS price"]
_TEXT_SQL = f"SELECT {', '.join(_TEXT)} FROM orders"
_NAMES = ["id", "priority", "price"]


def _orders_text(spark, d):
    return table(spark, d, "orders").selectExpr(*_TEXT)


@query(
    "read_delimited", "A1",
    "SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS priority, "
    "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price FROM orders",
)
def read_delimited(spark, d):
    path = scratch_path(spark, "delimited")
    missing = F.when(F.col("o_orderstatus") == "P", "nan").otherwise(F.col("o_orderpriority"))
    rows = table(spark, d, "orders").withColumn("o_orderpriority", missing).selectExpr(*_TEXT)
    rows.write.option("sep", ";").option("header", True).csv(path)
    return readers.read_delimited(spark, path, _NAMES, sep=";")


@query("read_tsv_legacy", "A2", _TEXT_SQL)
def read_tsv_legacy(spark, d):
    path = scratch_path(spark, "tsv")
    _orders_text(spark, d).write.option("sep", "\t").option("header", True).option(
        "encoding", "ISO-8859-1"
    ).csv(path)
    return readers.read_tsv_legacy(spark, path, _NAMES, region="apj")


def _framed(spark, d, path):
    """Files of up to 5000 orders: a title line, a header line, the rows, a total line."""
    body = _orders_text(spark, d).select(
        F.concat_ws(",", *_NAMES).alias("value"), F.floor(F.col("id").cast("bigint") / 5000).alias("file")
    )
    files = body.select("file").distinct()
    frame = files.select(
        "file", F.explode(F.array(F.lit("0 extract of orders"), F.lit("1 id,priority,price"), F.lit("9 total"))).alias("t")
    )
    lines = body.select("file", F.lit("2").alias("rank"), "value").unionByName(
        frame.select("file", F.substring("t", 1, 1).alias("rank"), F.substring("t", 3, 100).alias("value"))
    )
    lines.repartition("file").sortWithinPartitions("file", "rank").select("file", "value").write.partitionBy("file").text(path)


@query("skip_header_rows", "A3 A4 D3", _TEXT_SQL)
def skip_header_rows(spark, d):
    path = scratch_path(spark, "framed")
    _framed(spark, d, path)
    config = EntityConfig(
        required_column_list=tuple(_NAMES), header_row_number_to_select=1, remove_trailer_rows=-1
    )
    return readers.read_entity(spark, path, config).select(*_NAMES)


@query("read_tables", "A13", f"SELECT 'narrow' AS part, id, priority FROM ({_TEXT_SQL}) UNION ALL SELECT 'renamed', id, priority FROM ({_TEXT_SQL})")
def read_tables(spark, d):
    """Two logical tables from one file, each with its own column names."""
    path = scratch_path(spark, "two-tables")
    _orders_text(spark, d).write.option("header", True).csv(path)
    tables = readers.read_tables(
        spark, path,
        {
            "narrow": EntityConfig(required_column_list=("id", "priority")),
            "renamed": EntityConfig(required_column_list=("key", "class", "amount"), force_column_names=True),
        },
    )
    narrow = tables["narrow"].select(F.lit("narrow").alias("part"), "id", "priority")
    renamed = tables["renamed"].select(F.lit("renamed"), "key", "class")
    return narrow.unionAll(renamed)


_FILE_ROWS = """SELECT n_name AS nation, count(*) AS line_count FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""


@query("read_manifest", "A5", f"SELECT 'metadata_' || nation || '.csv' AS listed_name, line_count AS declared_size FROM ({_FILE_ROWS})")
def read_manifest(spark, d):
    """One manifest line per nation, written as ``name|size``."""
    path = scratch_path(spark, "manifest")
    counted = table(spark, d, "customer").join(
        table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))
    line = F.concat(F.lit("metadata_"), "n_name", F.lit(".csv|"), F.col("n").cast("string"))
    counted.select(line.alias("value"), "n_name").write.partitionBy("n_name").text(path)
    return readers.read_manifest(spark, f"{path}/n_name=*", prefix="part-").select(
        "listed_name", "declared_size"
    )


@query("list_landing", "A6", "SELECT n_name AS folder, 1 AS data_files, 0 AS manifest_files, true AS has_size FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY n_name")
def list_landing(spark, d):
    path = scratch_path(spark, "landing")
    table(spark, d, "customer").join(
        table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("n_name", F.concat_ws(",", "c_custkey", "c_name").alias("value")).repartition(
        "n_name"
    ).write.partitionBy("n_name").text(path)
    listing = readers.list_landing(spark, f"{path}/n_name=*", "*.txt")
    data, manifests = split_listing(listing)
    folder = F.regexp_extract("path", "n_name=([^/]+)/", 1).alias("folder")
    kinds = data.select(folder, "length", F.lit(1).alias("d"), F.lit(0).alias("m")).unionAll(
        manifests.select(folder, "length", F.lit(0), F.lit(1))
    )
    return kinds.groupBy("folder").agg(
        F.sum("d").alias("data_files"), F.sum("m").alias("manifest_files"), F.bool_and(F.col("length") > 0).alias("has_size")
    )


@query("stage_overwrite", "A7", f"WITH {DIRTY_ORDERS_SQL} SELECT * FROM dirty")
def stage_overwrite(spark, d):
    path = scratch_path(spark, "staged")
    sinks.stage_overwrite(dirty_orders(spark, d).withColumn("status", F.lit("earlier run")), path)
    return sinks.stage_overwrite(dirty_orders(spark, d), path)


@query(
    "write_piped", "A8 A9",
    f"""SELECT id, priority, price, 'orders.csv' AS "SOURCE_NAME", 'loader' AS "CREATED_BY", '2024-03-01' AS "BATCH_RUN_DT" FROM ({_TEXT_SQL})""",
)
def write_piped(spark, d):
    path = scratch_path(spark, "piped")
    for _ in range(2):
        sinks.write_piped(_orders_text(spark, d), path, "orders.csv", "loader", dt.date(2024, 3, 1))
    names = [*_NAMES, "SOURCE_NAME", "CREATED_BY", "BATCH_RUN_DT"]
    return readers.read_delimited(spark, path, names, sep="|")


@query(
    "write_rejects", "A10",
    f"""WITH {DIRTY_ORDERS_SQL} SELECT {', '.join(RECORD)}, {_REASONS} AS reject_reason, 'orders' AS entity, DATE '2024-03-01' AS dt FROM dirty WHERE {_ANY_BAD}""",
)
def write_rejects(spark, d):
    path = scratch_path(spark, "rejects")
    rejects = R.failed(_checked(spark, d)).withColumn("reject_reason", F.array_join("reject_reason", ","))
    for _ in range(2):
        sinks.write_rejects(rejects.drop("rejected_column"), path, "orders", dt.date(2024, 3, 1))
    return spark.read.parquet(path)


@query(
    "archive_layout", "A11",
    f"SELECT id, priority, price, DATE '2024-03-01' AS dt, 'orders' AS logical_name FROM ({_TEXT_SQL})",
)
def archive_layout(spark, d):
    path = scratch_path(spark, "archive")
    sinks.archive_layout(_orders_text(spark, d), path, "orders", dt.date(2024, 3, 1))
    return spark.read.parquet(path)


@query(
    "append_audit", "A12",
    """SELECT step AS processname, o_orderpriority AS filename, count(*) AS landingcount FROM orders,
       (VALUES ('FileValidation'), ('DataValidation')) v(step) GROUP BY 1, 2""",
)
def append_audit(spark, d):
    path = scratch_path(spark, "audit")
    counts = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("filename")).agg(
        F.count(F.lit(1)).alias("landingcount")
    )
    for step in ("FileValidation", "DataValidation"):
        sinks.append_audit(counts.withColumn("processname", F.lit(step)), path)
    return spark.read.schema(A.AUDIT_SCHEMA).parquet(path).select("processname", "filename", "landingcount")


@query(
    "write_snapshot", "J5 A9",
    """SELECT o_orderkey, o_orderstatus, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
       CASE WHEN CAST(date_trunc('month', o_orderdate) AS DATE) = (SELECT CAST(date_trunc('month', max(o_orderdate)) AS DATE) FROM orders) THEN 'Y' ELSE 'N' END AS is_latest_fg FROM orders""",
)
def write_snapshot(spark, d):
    from landflow.operators.snapshot import latest_snapshot

    path = scratch_path(spark, "snapshots")
    rows = table(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("snapshot_date")
    )
    for _ in range(2):
        sinks.write_snapshot(rows.repartition("snapshot_date"), path)
    return latest_snapshot(spark.read.parquet(path))




# ---------------------------------------------------------------- records and headers that are not as declared


def _quoted(c):
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


@query(
    "quoted_text", "A1",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, 'say "' || o_orderpriority || '", twice' || chr(10) || 'and again' AS priority,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price FROM orders""",
)
def quoted_text(spark, d):
    """Text with quotes, separators and line breaks in it."""
    path = scratch_path(spark, "quoted")
    said = F.concat(F.lit('say "'), "priority", F.lit('", twice\nand again'))
    lines = _orders_text(spark, d).select(F.concat_ws(",", "id", _quoted(said), "price").alias("value"))
    lines.write.text(path)
    return readers.read_delimited(spark, path, _NAMES, header=False, multi_line=True)


_RAGGED = EntityConfig.from_dict(
    {"required_column_list": _NAMES, "notnull_columns": ["id"], "input_file_extension": "csv"}
)


@query(
    "malformed_rows", "A1 C1 I1",
    """SELECT CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderkey AS VARCHAR) || ',' || o_orderpriority
                   WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey AS VARCHAR) || ',' || o_orderpriority || ',1,more'
                   ELSE CAST(o_orderkey AS VARCHAR) END AS record,
              CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 5 = 0 THEN 'record_malformed' END AS reason FROM orders""",
)
def malformed_rows(spark, d):
    """Records with a field too few or too many are rejected whole, with their text; the others pass."""
    path = scratch_path(spark, "ragged")
    key = F.col("id").cast("bigint")
    fields = F.when(key % 7 == 0, F.concat_ws(",", "id", "priority")).when(
        key % 5 == 0, F.concat_ws(",", "id", "priority", F.lit("1"), F.lit("more"))
    ).otherwise(F.concat_ws(",", "id", "priority", F.lit("1")))
    _orders_text(spark, d).select(fields.alias("value")).write.text(path)
    rows = readers.read_delimited(spark, path, _NAMES, header=False, with_source=True, malformed=readers.MALFORMED)
    found = entity_load.check_entity(rows, _RAGGED)
    bad = found.rejects.select(F.col(readers.MALFORMED).alias("record"), F.col("reject_reason")[0].alias("reason"))
    return found.clean.select(F.col("id").alias("record"), F.lit(None).cast("string").alias("reason")).union(bad)


def _one_task_a_file(lines):
    """All lines of a file in one task, in order; the files over many tasks."""
    return lines.repartition("file").sortWithinPartitions("file", "rank")


@query(
    "header_parses", "B11",
    """SELECT 'orders' || f || '_20240301050000.csv' AS file_name,
              CASE WHEN f % 3 = 0 THEN 'File integrity check failed' END AS reason
       FROM (SELECT DISTINCT o_custkey % 10 AS f FROM orders)""",
)
def header_parses(spark, d):
    """Every third file has a column more in its header than the entity declares."""
    path = scratch_path(spark, "headers")
    rows = table(spark, d, "orders").select(
        (F.col("o_custkey") % 10).alias("file"), F.concat_ws(",", "o_orderkey", "o_orderpriority", "o_orderstatus").alias("value")
    )
    header = F.when(F.col("file") % 3 == 0, "id,priority,status,more").otherwise("id,priority,status")
    lines = rows.select("file", F.lit(1).alias("rank"), "value").unionByName(
        rows.select("file").distinct().select("file", F.lit(0).alias("rank"), header.alias("value"))
    )
    _one_task_a_file(lines).select("file", "value").write.partitionBy("file").text(path)
    found = readers.header_columns(spark, f"{path}/*")
    number = F.regexp_extract("path", "file=([0-9]+)", 1)
    name = F.concat(F.lit("orders"), number, F.lit("_20240301050000.csv"))
    listing = found.select(name.alias("file_name"), name.alias("path"), "header_columns")
    data = listing.select("file_name", "path", F.lit(10).cast("long").alias("length"), F.lit(RUN_1).alias("modificationTime"))
    manifest = listing.select(
        F.concat(F.lit(MANIFEST_PREFIX), "file_name").alias("manifest_name"),
        F.col("file_name").alias("listed_name"), F.lit(10).cast("long").alias("declared_size"),
    )
    judged = admission_verdict(
        data, manifest, RUN_1, {"orders": "csv"}, prefixes=["orders"], aliases=["orders"],
        header_columns=listing.select("path", "header_columns"), column_counts={"orders": 3},
    )
    return judged.select("file_name", "reason")


_HEADERS = {0: "id,priority,price", 1: "price,id,priority", 2: "priority,price", 3: "id,more,priority,price", 4: " price , priority , id ", 5: "id,price,price,priority"}
_BY_NAME = EntityConfig.from_dict({"required_column_list": _NAMES, "notnull_columns": ["id"], "unknown_columns": "reject"})


@query(
    "header_mapping", "A1 C1 C2 I1",
    """SELECT CASE WHEN o_custkey % 6 = 2 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS id, o_orderpriority || '", a' AS priority,
              CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
              CASE o_custkey % 6 WHEN 2 THEN 'id_missing_in_header,id_null_check_failed' WHEN 3 THEN 'more_not_declared' WHEN 5 THEN 'price_repeated_in_header' END AS reasons
       FROM orders""",
)
def header_mapping(spark, d):
    """Files with their columns in another order, one too few, one too many, one twice: found by name or rejected."""
    path = scratch_path(spark, "mapped")
    text = table(spark, d, "orders").select(
        (F.col("o_custkey") % 6).alias("file"), F.expr(_TEXT[0]), _quoted(F.concat("o_orderpriority", F.lit('", a'))).alias("priority"), F.expr(_TEXT[2]), F.lit("m").alias("more")
    )
    line = F.coalesce(*[F.when(F.col("file") == n, F.concat_ws(",", *[c.strip() for c in h.split(",")])) for n, h in _HEADERS.items()])
    heads = spark.createDataFrame(list(_HEADERS.items()), "file long, value string").join(text.select("file").distinct(), "file")
    lines = text.select("file", F.lit(1).alias("rank"), line.alias("value")).unionByName(heads.select("file", F.lit(0).alias("rank"), "value"))
    _one_task_a_file(lines).select("file", "value").write.partitionBy("file").text(path)
    found = entity_load.check_entity(readers.read_entity(spark, f"{path}/*", _BY_NAME), _BY_NAME, "emea")
    shown = lambda rows, reasons: rows.select(F.nullif("id", F.lit("")).alias("id"), "priority", "price", reasons.alias("reasons"))
    return shown(found.clean, F.lit(None).cast("string")).unionAll(shown(found.rejects, F.array_join("reject_reason", ",")))


@query(
    "landing_with_empty_files", "A6 B8",
    """SELECT r_name AS folder, count(*) AS files, count(*) FILTER (WHERE n_nationkey % 5 = 0) AS empty_files, true AS dated
       FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey IN (SELECT c_nationkey FROM customer) GROUP BY r_name""",
)
def landing_with_empty_files(spark, d):
    """A folder for each region with a file for each nation; some have no byte in them."""
    path = scratch_path(spark, "empties")
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    full = rows.where("n_nationkey % 5 > 0").select("r_name", "n_name", "c_name")
    full.repartition("n_name").write.partitionBy("r_name", "n_name").text(path)
    # an unquoted CSV of no column at all writes files without a byte
    none = rows.where("n_nationkey % 5 = 0").select("r_name", "n_name").distinct()
    none.withColumn("c_name", F.lit(None).cast("string")).repartition("n_name").write.mode("append").option("nullValue", "").option("emptyValue", "").option("lineSep", "\n").partitionBy("r_name", "n_name").csv(path)
    listed = readers.list_landing(spark, f"{path}/r_name=*", "part-*")
    folder = F.regexp_extract("path", "r_name=([^/]+)/", 1)
    return listed.groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("length") <= 1).alias("empty_files"), F.bool_and(F.col("modificationTime").isNotNull()).alias("dated")
    )
