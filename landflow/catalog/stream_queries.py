"""Streaming queries, run over what has landed and then stopped."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from landflow.catalog.base import RUN_1, query, table, utc
from landflow.catalog.run_queries import _FILE_CONFIG, _land_files, _orders_sql
from landflow.config import EntityConfig
from landflow.operators.history import HistorySpec
from landflow.plans import publish, run
from landflow.session import scratch_path
from landflow.streaming import entity, replay
from landflow.streaming import micro_batch as M

_LOWER = utc("2024-01-05 00:00:00")
_NOW = utc("2024-01-29 00:00:00")


def _land(spark, d, path, times: int = 1):
    """Events as landed files; the schema of those files."""
    rows = table(spark, d, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type"
    )
    for _ in range(times):
        rows.repartition(4, "user_id").write.mode("append").parquet(path)
    return rows.schema


@query(
    "stream_scd2", "M1 M3 J2",
    """WITH usable AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-29 00:00:00')
       SELECT user_id, event_id, event_type, CAST(row_number() OVER w AS INTEGER) AS version, ts AS start_date, lead(ts) OVER w AS end_date,
              CASE WHEN lead(event_id) OVER w IS NULL THEN 'Y' ELSE 'N' END AS is_current_fg
       FROM usable WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
       UNION ALL SELECT user_id, event_id, event_type, NULL, ts, NULL, 'rejected' FROM events
       WHERE ts < TIMESTAMP '2024-01-05 00:00:00' OR ts > TIMESTAMP '2024-01-29 00:00:00'""",
)
def stream_scd2(spark, d):
    """Each micro-batch is checked and merged, all versions of a key in it; stale rows go to a reject folder."""
    root = scratch_path(spark, "stream")
    schema = _land(spark, d, f"{root}/landing")
    spec = HistorySpec(keys=("user_id",), change_column="event_id", order_column="ts", start_from="ts")

    def handle(rows, epoch):
        guarded = M.stale_guard(rows, "ts", _NOW, 24 * 365, _LOWER)
        guarded.filter("stale_reason IS NOT NULL").write.mode("overwrite").parquet(
            f"{root}/rejects/epoch={epoch}"
        )
        usable = guarded.filter("stale_reason IS NULL").drop("stale_reason")
        run = _NOW + dt.timedelta(hours=epoch)
        publish.publish_history(usable, f"{root}/published", spec, run, f"epoch_{epoch}", parts=4)

    stream = M.file_stream(spark, f"{root}/landing", schema, "parquet", files_per_trigger=2)
    M.run_available(stream, handle, f"{root}/checkpoint")
    versions = publish.read_published(spark, f"{root}/published", publish.stored_schema(spark, f"{root}/published"))
    rejects = spark.read.parquet(f"{root}/rejects").withColumns(
        {
            "version": F.lit(None).cast("int"), "start_date": F.col("ts"), "end_date": F.lit(None).cast("timestamp"),
            "is_current_fg": F.lit("rejected"),
        }
    )
    wanted = ["user_id", "event_id", "event_type", "version", "start_date", "end_date", "is_current_fg"]
    return versions.select(*wanted).union(rejects.select(*wanted))


@query(
    "replay_dedup_stream", "M2",
    """SELECT event_id, ts, user_id, event_type, 'fresh' AS outcome FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00'
       UNION ALL SELECT event_id, ts, user_id, event_type, 'replayed' FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00'
       UNION ALL SELECT event_id, ts, user_id, event_type, 'late' FROM events, (VALUES (1), (2)) t(n) WHERE ts < TIMESTAMP '2024-01-05 00:00:00'""",
)
def replay_dedup_stream(spark, d):
    """Every file lands twice, one file a trigger and in no order of time; each row comes out once, if it isn't late."""
    root = scratch_path(spark, "replay")
    schema = _land(spark, d, f"{root}/landing", times=2)
    stream = M.file_stream(spark, f"{root}/landing", schema, "parquet", files_per_trigger=1)
    marked = replay.mark_replays(stream, ["event_id"], "ts", _NOW, _NOW - _LOWER)
    M.run_available(marked, lambda rows, epoch: replay.write_outcomes(rows, epoch, f"{root}/out"), f"{root}/checkpoint")
    found = [
        replay.read_outcome(spark, f"{root}/out", outcome, schema).withColumn("outcome", F.lit(outcome))
        for outcome in (replay.FRESH, replay.REPLAYED, replay.LATE)
    ]
    return found[0].unionAll(found[1]).unionAll(found[2])


@query(
    "stale_guard", "M3 K6",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'missing' WHEN ts > TIMESTAMP '2024-01-29 00:00:00' THEN 'future'
       WHEN ts < TIMESTAMP '2024-01-05 00:00:00' THEN 'before_lower_bound' WHEN ts < TIMESTAMP '2024-01-19 00:00:00' THEN 'late' END AS stale_reason FROM events""",
)
def stale_guard(spark, d):
    df = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("ts")
    )
    return M.stale_guard(df, "ts", _NOW, 240, _LOWER).select("event_id", "stale_reason")


@query(
    "hourly_metrics_stream", "M5",
    """SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS arrivals, count(*) FILTER (WHERE user_id % 2 = 0) AS rejects
       FROM events GROUP BY 1, 2""",
)
def hourly_metrics_stream(spark, d):
    """Counts appended trigger by trigger, rows late or not, add up to the batch counts."""
    root = scratch_path(spark, "hourly")
    schema = _land(spark, d, f"{root}/landing")
    stream = M.file_stream(spark, f"{root}/landing", schema, "parquet", files_per_trigger=1)
    even = F.col("user_id") % 2 == 0
    M.run_available(
        stream,
        lambda rows, epoch: M.hourly_batch(rows, epoch, f"{root}/out", "ts", even, ["event_type"]),
        f"{root}/checkpoint",
    )
    return M.hourly_totals(spark, f"{root}/out", ["event_type"])


@query(
    "stream_entity", "M1 A1 K11",
    f"""SELECT o.* FROM ({_orders_sql('2, 3, 4, 5', ", 1 AS failed_files")}) o""",
)
def stream_entity(spark, d):
    """Each new file is checked and published by the configuration, a few files a trigger; one is rejected whole."""
    root = scratch_path(spark, "stream_entity")
    _land_files(spark, d, f"{root}/landing", swapped=True)
    config = EntityConfig.from_dict(_FILE_CONFIG | {"reject_files": True})
    entity.stream_entity(spark, f"{root}/landing", config, root, RUN_1, "orders", files_per_trigger=2, parts=4)
    failed = run.audit_of(spark, root).where("processname = 'LandingToRaw' AND executionstatus = 'Failed' AND sourcename <> 'orders'").count()
    return publish.read_published(spark, f"{root}/published/orders").select("id", "status", "price", F.lit(failed).alias("failed_files"))
