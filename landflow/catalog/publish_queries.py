"""Published tables, batch after batch, over the cases in which rows are easily lost."""

from __future__ import annotations

from pyspark.sql import functions as F

from landflow.catalog.base import RUN_1, RUN_2, query, table, utc
from landflow.operators import rules as R
from landflow.operators.history import HistorySpec, rollback_before_file
from landflow.plans import publish
from landflow.session import scratch_path
from landflow.sources import sinks

_SPLIT = utc("2024-01-15 00:00:00")


def _two_batches(spark, path, spec, first, second, **more):
    """Both batches published; what the second did."""
    for batch, rows, run in (("b1", first, RUN_1), ("b2", second, RUN_2)):
        staged = sinks.stage_overwrite(rows, f"{path}/staged/{batch}")
        done = publish.publish_history(staged, f"{path}/table", spec, run, batch, **more)
    return done, publish.read_published(spark, f"{path}/table", done.schema)


@query(
    "publish_null_part", "J1",
    """WITH keyed AS (SELECT o_orderkey, CASE WHEN o_custkey % 7 > 0 THEN CAST(o_orderdate AS DATE) END AS day, o_orderstatus AS marker FROM orders)
       SELECT o_orderkey, day, marker || 'x' AS marker, 2 AS version, 'Y' AS is_current_fg FROM keyed WHERE o_orderkey % 5 = 0
       UNION ALL SELECT o_orderkey, day, marker, 1, CASE WHEN o_orderkey % 5 = 0 THEN 'N' ELSE 'Y' END FROM keyed""",
)
def publish_null_part(spark, d):
    """Parts by month of a key date that is missing for every seventh customer."""
    day = F.when(F.col("o_custkey") % 7 > 0, F.col("o_orderdate").cast("date"))
    rows = table(spark, d, "orders").select("o_orderkey", day.alias("day"), F.col("o_orderstatus").alias("marker"))
    changed = rows.where("o_orderkey % 5 = 0").withColumn("marker", F.concat("marker", F.lit("x")))
    spec = HistorySpec(keys=("o_orderkey", "day"), change_column="marker", date_keys=("day",))
    month = F.year("day") * 100 + F.month("day")
    _, found = _two_batches(spark, scratch_path(spark, "null_part"), spec, rows, changed, part=month)
    return found.select("o_orderkey", "day", "marker", "version", "is_current_fg")


@query(
    "publish_many_versions", "J1 J2 J4",
    """WITH marked AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS was FROM events),
       kept AS (SELECT user_id, ts, event_type FROM marked WHERE was IS DISTINCT FROM event_type)
       SELECT user_id, event_type, CAST(row_number() OVER w AS INTEGER) AS version, ts AS start_date, lead(ts) OVER w AS end_date,
              CASE WHEN lead(ts) OVER w IS NULL THEN 'Y' ELSE 'N' END AS is_current_fg
       FROM kept WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type)""",
)
def publish_many_versions(spark, d):
    """All events of a user as versions, although each batch holds many of them."""
    rows = table(spark, d, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    spec = HistorySpec(keys=("user_id",), change_column="event_type", order_column="ts", start_from="ts")
    early = F.col("ts") < F.lit(_SPLIT)
    _, found = _two_batches(spark, scratch_path(spark, "versions"), spec, rows.where(early), rows.where(~early), parts=8)
    return found.select("user_id", "event_type", "version", "start_date", "end_date", "is_current_fg")


@query(
    "publish_key_conflicts", "J1 K7",
    """WITH judged AS (SELECT l.l_orderkey, l_linenumber, lines > 1 AS unlike FROM lineitem l
           JOIN (SELECT l_orderkey, count(DISTINCT l_linenumber) AS lines FROM lineitem GROUP BY 1) n ON n.l_orderkey = l.l_orderkey)
       SELECT l_orderkey, l_linenumber, 'conflict' AS outcome FROM judged WHERE unlike
       UNION ALL SELECT DISTINCT l_orderkey, l_linenumber, 'current' FROM judged WHERE NOT unlike""",
)
def publish_key_conflicts(spark, d):
    """Unlike rows of one key, and no column to say which comes first: refused with a reason, not picked from."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    spec = HistorySpec(keys=("l_orderkey",), change_column="l_linenumber")
    path = scratch_path(spark, "conflicts")
    done = publish.publish_history(sinks.stage_overwrite(rows, f"{path}/staged"), f"{path}/table", spec, RUN_1, "b1", parts=8)
    refused = publish.read_refused(spark, done).select("l_orderkey", "l_linenumber", F.col("_kind").alias("outcome"))
    current = publish.read_current(spark, f"{path}/table", done.schema)
    return current.select("l_orderkey", "l_linenumber", F.lit("current").alias("outcome")).union(refused)


@query(
    "publish_missing_column", "J1 J4",
    """SELECT o_orderkey, o_orderpriority, o_orderstatus || 'x' AS marker, 2 AS version, 'Y' AS is_current_fg FROM orders WHERE o_orderkey % 10 = 0
       UNION ALL SELECT o_orderkey, o_orderpriority, o_orderstatus, 1, CASE WHEN o_orderkey % 10 = 0 THEN 'N' ELSE 'Y' END FROM orders""",
)
def publish_missing_column(spark, d):
    """The second batch lacks a column of the table: its keys and all others keep the values they had."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.col("o_orderstatus").alias("marker"))
    changed = rows.where("o_orderkey % 10 = 0").select("o_orderkey", F.concat("marker", F.lit("x")).alias("marker"))
    spec = HistorySpec(keys=("o_orderkey",), change_column="marker")
    _, found = _two_batches(spark, scratch_path(spark, "missing"), spec, rows, changed, parts=8)
    return found.select("o_orderkey", "o_orderpriority", "marker", "version", "is_current_fg")


@query(
    "publish_counts", "J1 A7 L1",
    """SELECT count(*) FILTER (WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 = 1) AS inserted,
              count(*) FILTER (WHERE o_orderkey % 6 = 0 AND o_orderkey % 5 = 0) AS updated,
              count(*) FILTER (WHERE o_orderkey % 6 = 0 AND o_orderkey % 5 > 0) AS unchanged FROM orders""",
)
def publish_counts(spark, d):
    """Even keys, then every third key with every fifth changed."""
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("marker"))
    changed = F.when(F.col("o_orderkey") % 5 == 0, F.concat("marker", F.lit("x"))).otherwise(F.col("marker"))
    second = rows.where("o_orderkey % 3 = 0").withColumn("marker", changed)
    spec = HistorySpec(keys=("o_orderkey",), change_column="marker")
    done, _ = _two_batches(spark, scratch_path(spark, "counts"), spec, rows.where("o_orderkey % 2 = 0"), second, parts=8)
    return spark.createDataFrame([(done.inserted, done.updated, done.unchanged)], "inserted long, updated long, unchanged long")


@query(
    "rollback_unchanged_file", "J8",
    "SELECT o_orderkey, o_orderstatus AS marker, 'f1' AS source_file, 1 AS version, 'Y' AS is_current_fg FROM orders",
)
def rollback_unchanged_file(spark, d):
    """A second extract brought nothing new; undoing it, or a file never seen, changes nothing."""
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("marker"))
    spec = HistorySpec(keys=("o_orderkey",), change_column="marker")
    first, second = (rows.withColumn("source_file", F.lit(f)) for f in ("f1", "f2"))
    _, found = _two_batches(spark, scratch_path(spark, "undone"), spec, first, second, parts=8)
    for name in ("f2", "never seen"):
        found = rollback_before_file(found, name, spec)
    return found.select("o_orderkey", "marker", "source_file", "version", "is_current_fg")


@query(
    "key_unique_rule", "K7",
    """SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1
       THEN 'business_key_not_unique' END AS reject_reason FROM lineitem""",
)
def key_unique_rule(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    marked = R.key_unique_rule(rows, ["l_orderkey", "l_linenumber"])
    return marked.select(*rows.columns, F.get(R.REJECTS, F.lit(0))["reason"].alias("reject_reason"))


@query(
    "replay_rule", "K9",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'already_published' END AS reject_reason FROM events""",
)
def replay_rule(spark, d):
    """A batch of all events, of which two types are published already."""
    rows = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    published = rows.where(F.col("event_type").isin("click", "view"))
    marked = R.replay_rule(rows, published, ["event_id"], "ts", "event_type")
    return marked.select("event_id", F.get(R.REJECTS, F.lit(0))["reason"].alias("reject_reason"))


# ---------------------------------------------------------------- long life: crashes, re-extracts, older versions

_MARKED = ["o_orderkey", "CAST(o_orderdate AS TIMESTAMP) AS modified", "o_orderstatus AS marker"]
_BY_DATE = HistorySpec(keys=("o_orderkey",), change_column="marker", order_column="modified")
_THIRD = "o_orderkey % 3 = 0"


def _later(rows, suffix):
    """Every third row, a year later and with another marker."""
    return rows.where(_THIRD).withColumns({"modified": F.expr("modified + INTERVAL 1 YEAR"), "marker": F.concat("marker", F.lit(suffix))})


def _three_versions(spark, d, label):
    """A table with three batches: all orders, then every third changed twice."""
    path = f"{scratch_path(spark, label)}/table"
    rows = table(spark, d, "orders").selectExpr(*_MARKED)
    second = _later(rows, "x")
    for batch, part, run in (("b1", rows, RUN_1), ("b2", second, RUN_2), ("b3", _later(second, "y"), _RUN_3)):
        publish.publish_history(part, path, _BY_DATE, run, batch, parts=8)
    return path


_RUN_3 = utc("2024-03-03 06:00:00")
_SHOWN = ["o_orderkey", "marker", "version", "is_current_fg"]
_VERSIONS = {
    1: "SELECT o_orderkey, o_orderstatus AS marker, 1 AS version, {flag} AS is_current_fg FROM orders",
    2: f"SELECT o_orderkey, o_orderstatus || 'x' AS marker, 2 AS version, {{flag}} AS is_current_fg FROM orders WHERE {_THIRD}",
    3: f"SELECT o_orderkey, o_orderstatus || 'xy' AS marker, 3 AS version, {{flag}} AS is_current_fg FROM orders WHERE {_THIRD}",
}


def _at_version(n):
    """SQL of the table's rows when ``n`` batches were published."""
    flag = f"CASE WHEN {_THIRD} THEN 'N' ELSE 'Y' END"
    return " UNION ALL ".join(_VERSIONS[v].format(flag="'Y'" if v == n else flag if v == 1 else "'N'") for v in range(1, n + 1))


@query("published_as_of", "J7 J1", f"SELECT *, 'by version' AS how FROM ({_at_version(2)}) UNION ALL SELECT *, 'by time' FROM ({_at_version(1)})")
def published_as_of(spark, d):
    """The table as it was published, by its version and by a moment between two runs."""
    path = _three_versions(spark, d, "as_of")
    one = publish.read_published(spark, path, as_of=2).select(*_SHOWN, F.lit("by version").alias("how"))
    return one.unionAll(publish.read_published(spark, path, as_of=utc("2024-03-01 18:00:00")).select(*_SHOWN, F.lit("by time")))


@query("published_rollback", "J8 J1", _at_version(2))
def published_rollback(spark, d):
    """Rolled back to its first version; the second batch is then published again, and brings the same rows."""
    path = _three_versions(spark, d, "rolled")
    publish.rollback_published(spark, path, 1, utc("2024-03-04 06:00:00"))
    rows = _later(table(spark, d, "orders").selectExpr(*_MARKED), "x")
    publish.publish_history(rows, path, _BY_DATE, utc("2024-03-05 06:00:00"), "again", parts=8)
    return publish.read_published(spark, path).select(*_SHOWN)


@query("published_vacuum", "J7 J1", f"SELECT *, true AS smaller FROM ({_at_version(3)})")
def published_vacuum(spark, d):
    """Folders that no kept version names are gone, the newest version has all its rows."""
    path = _three_versions(spark, d, "vacuumed")
    gone = publish.vacuum_published(spark, path)
    return publish.read_published(spark, path).select(*_SHOWN, F.lit(any(name.startswith("0") for name in gone)).alias("smaller"))


@query("publish_reextract", "J1 J2", "SELECT count(*) AS unchanged, 0 AS stale, 0 AS versions, 1 AS manifests FROM orders")
def publish_reextract(spark, d):
    """The same extract once more: every row is unchanged, none is refused as old, and nothing is written."""
    path = f"{scratch_path(spark, 'reextract')}/table"
    rows = table(spark, d, "orders").selectExpr(*_MARKED)
    publish.publish_history(rows, path, _BY_DATE, RUN_1, "b1", parts=8)
    done = publish.publish_history(rows, path, _BY_DATE, RUN_2, "b2", parts=8)
    found = (done.unchanged, done.stale, done.versions, len(publish.manifests(spark, path)))
    return spark.createDataFrame([found], "unchanged long, stale int, versions int, manifests int")


@query("publish_after_crash", "J1 A7", _at_version(2))
def publish_after_crash(spark, d):
    """A driver died while it wrote the second manifest: its remains are there, and the batch is published again."""
    path = f"{scratch_path(spark, 'crashed')}/table"
    rows = table(spark, d, "orders").selectExpr(*_MARKED)
    publish.publish_history(rows, path, _BY_DATE, RUN_1, "b1", parts=8)
    half = spark.range(1).select(F.lit(2).cast("long").alias("version"), F.lit("current").alias("kind"), F.lit(0).alias("part"), F.lit("nowhere").alias("folder"))
    half.write.json(f"{path}/manifest/000000000002-change-dead/_temporary/0")
    publish.publish_history(_later(rows, "x"), path, _BY_DATE, RUN_2, "b2", parts=8)
    return publish.read_published(spark, path).select(*_SHOWN)
