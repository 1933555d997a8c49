"""Streams: keyed state over restarts, and entities run as their files land."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from landflow.config import EntityConfig
from landflow.plans import publish, run
from landflow.streaming import entity, replay
from landflow.streaming import micro_batch as M
from tests.conftest import rows

UTC = dt.timezone.utc
NOW = dt.datetime(2024, 3, 1, 6, tzinfo=UTC)
SCHEMA = "k string, ts timestamp, v int"


def land(spark, path, *data):
    spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").parquet(path)


def at(hours):
    return (NOW - dt.timedelta(hours=hours)).replace(tzinfo=None)


@pytest.mark.parametrize("per_trigger", [1, 10])
def test_replays_are_told_over_restarts(spark, tmp_path, per_trigger):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = spark.createDataFrame([], SCHEMA).schema

    def run_once():
        stream = M.file_stream(spark, landing, schema, "parquet", files_per_trigger=per_trigger)
        marked = replay.mark_replays(stream, ["k"], "ts", NOW, dt.timedelta(hours=48))
        M.run_available(marked, lambda df, epoch: replay.write_outcomes(df, epoch, out), str(tmp_path / "checkpoint"))

    land(spark, landing, ("a", at(1), 1), ("a", at(2), 1), (None, at(1), 1))
    land(spark, landing, ("a", at(1), 2), ("b", None, 1), ("old", at(99), 1))
    run_once()
    land(spark, landing, ("a", at(2), 3), ("b", None, 3), (None, at(1), 3), ("c", at(3), 3), ("old", at(99), 3))
    run_once()
    found = {o: rows(replay.read_outcome(spark, out, o, schema).select("k", F.unix_timestamp("ts"))) for o in ("fresh", "replayed", "late")}
    stamp = lambda h: int((NOW - dt.timedelta(hours=h)).timestamp())
    assert found["fresh"] == [(None, stamp(1)), ("a", stamp(2)), ("a", stamp(1)), ("b", None), ("c", stamp(3))] or found["fresh"] == sorted(
        [(None, stamp(1)), ("a", stamp(2)), ("a", stamp(1)), ("b", None), ("c", stamp(3))], key=lambda r: [(v is not None, str(v)) for v in r]
    )
    assert len(found["replayed"]) == 4 and found["late"] == [("old", stamp(99))] * 2


CONFIG = EntityConfig.from_dict(
    {
        "column_type_map": {"id": "string", "amount": "decimal(18,2)"}, "primary_key_columns": ["id"], "hash_columns": ["id", "amount"],
        "dq_checks": {"trim_spaces": True, "null_notnull_check": True}, "notnull_columns": ["id"], "admission": True, "max_sla_hours": 1_000_000,
        "allowed_prefixes": ["orders"],
    }
)


def put(folder, name, text, declared=None):
    (folder / f"{name}.csv").write_text(text)
    (folder / f"metadata_{name}.csv").write_text(f"{name}.csv|{len(text) if declared is None else declared}\n")


def test_stream_admits_checks_and_publishes_each_file_once(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()
    put(landing, "orders_20240301050000", "amount,id\n5,a\n6,b\n7,\n")
    put(landing, "orderx_20240301050000", "id,amount\nz,1\n", declared=3)
    now = lambda: dt.datetime.now(UTC)
    entity.stream_entity(spark, str(landing), CONFIG, root, now, "orders", parts=2)
    assert rows(publish.read_published(spark, f"{root}/published_orders").select("id", "amount")) == [("a", 5), ("b", 6)]
    put(landing, "orders_20240301060000", "id,amount\nb,9\nc,1\n")
    entity.stream_entity(spark, str(landing), CONFIG, root, now, "orders", parts=2)
    got = publish.read_published(spark, f"{root}/published_orders").select("id", "amount", "version", "is_current_fg")
    assert rows(got) == [("a", 5, 1, "Y"), ("b", 6, 1, "N"), ("b", 9, 2, "Y"), ("c", 1, 1, "Y")]
    audit = run.audit_of(spark, root)
    files = audit.where("processname = 'FileValidation' AND sourcename LIKE '%.csv'").select("sourcename", "executionstatus")
    assert rows(files) == [("orders_20240301050000.csv", "Succeeded"), ("orders_20240301060000.csv", "Succeeded"), ("orderx_20240301050000.csv", "Await")]
    last = audit.where("processname = 'CuratedToPublished' AND batchid = 'epoch_1'").first()
    assert (last["previouscount"], last["insertedcount"], last["updatedcount"]) == (2, 1, 1)


def test_run_refuses_whole_files_and_stops_if_none_is_left(spark, tmp_path):
    config = EntityConfig.from_dict({"column_type_map": {"id": "string", "amount": "decimal(18,2)"}, "primary_columns": ["id"], "hash_columns": ["id", "amount"],
        "dq_checks": {"trim_spaces": True, "null_notnull_check": True}, "notnull_columns": ["id"], "reject_files": True})
    landing, root = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()
    (landing / "one.csv").write_text("id,amount\na,1\n,2\nb,3\n")
    assert run.run_entity(spark, str(landing), config, root, NOW, "b1", parts=1) == "Failed"
    assert publish.manifests(spark, f"{root}/published_entity") == []
    (landing / "two.csv").write_text("id,amount\nc,1\n")
    assert run.run_entity(spark, str(landing), config, root, NOW, "b2", parts=1) == "Succeeded"
    assert rows(publish.read_published(spark, f"{root}/published_entity").select("id")) == [("c",)]
    errors = run.audit_of(spark, root).where("executionstatus = 'Failed'").select("batchid", "errormessage")
    assert rows(errors) == [("b1", "Full File Rejected as we have 1 rejection records"), ("b1", run.ALL_REJECTED), ("b2", "Full File Rejected as we have 1 rejection records")]


def test_replays_share_state_by_hour(spark, tmp_path):
    """2,000 keys of two hours in two files: state is looked up for shares of an hour, not for each key, and each key is fresh once."""
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = spark.createDataFrame([], SCHEMA).schema
    data = [(str(n), at(1 + n % 2), n) for n in range(2000)]
    land(spark, landing, *data, *data[:500])
    land(spark, landing, *data[1000:], *[(str(n), at(1), n) for n in range(2000, 2500)])
    stream = M.file_stream(spark, landing, schema, "parquet", files_per_trigger=1)
    marked = replay.mark_replays(stream, ["k"], "ts", NOW, dt.timedelta(hours=48))
    query = M.run_available(marked, lambda df, epoch: replay.write_outcomes(df, epoch, out), str(tmp_path / "checkpoint"))
    found = {o: rows(replay.read_outcome(spark, out, o, schema).select("v")) for o in ("fresh", "replayed")}
    assert found["fresh"] == sorted([(n,) for n in range(2500)], key=lambda r: str(r[0]))
    assert found["replayed"] == sorted([(n,) for n in [*range(500), *range(1000, 2000)]], key=lambda r: str(r[0]))
    kept = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert 0 < kept <= 2 * 2 * 2 * replay.DEALT  # a fingerprint list for each share of an hour and micro-batch, not one for each key
