"""Manifests of published tables: crashes, age, older versions, unchanged rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from landflow.operators.history import HistorySpec
from landflow.plans import publish
from landflow.sources import commits
from tests.conftest import rows

UTC = dt.timezone.utc
SPEC = HistorySpec(keys=("k",), change_column="h", order_column="v")


def run(n):
    return dt.datetime(2024, 3, 1, 6, tzinfo=UTC) + dt.timedelta(days=n)


def batch(spark, *data):
    return spark.createDataFrame(list(data), "k string, h string, v int")


def state(spark, path, **more):
    return rows(publish.read_published(spark, path, **more).select("k", "h", "version", "is_current_fg"))


def test_versions_times_rollback_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish_history(batch(spark, ("a", "1", 1), ("b", "1", 1)), path, SPEC, run(0), "b1", parts=2)
    publish.publish_history(batch(spark, ("a", "2", 2)), path, SPEC, run(1), "b2", parts=2)
    publish.publish_history(batch(spark, ("c", "1", 1), ("a", "3", 3)), path, SPEC, run(2), "b3", parts=2)
    first = [("a", "1", 1, "Y"), ("b", "1", 1, "Y")]
    second = [("a", "1", 1, "N"), ("a", "2", 2, "Y"), ("b", "1", 1, "Y")]
    third = [("a", "1", 1, "N"), ("a", "2", 2, "N"), ("a", "3", 3, "Y"), ("b", "1", 1, "Y"), ("c", "1", 1, "Y")]
    assert [state(spark, path, as_of=v) for v in (1, 2, 3)] == [first, second, third]
    assert state(spark, path, as_of=run(1) + dt.timedelta(hours=1)) == second
    with pytest.raises(ValueError, match="no version"):
        publish.read_published(spark, path, as_of=9)
    with pytest.raises(ValueError, match="had no version"):
        publish.read_published(spark, path, as_of=run(-1))

    assert publish.rollback_published(spark, path, 1, run(3)) == 4
    assert state(spark, path) == first and state(spark, path, as_of=3) == third
    publish.publish_history(batch(spark, ("b", "9", 5)), path, SPEC, run(4), "b5", parts=2)
    after = [("a", "1", 1, "Y"), ("b", "1", 1, "N"), ("b", "9", 2, "Y")]
    assert state(spark, path) == after
    publish.rollback_published(spark, path, 3, run(5))  # what was undone can be had back
    assert state(spark, path) == third

    publish.vacuum_published(spark, path, keep=2)
    assert [m.version for m in publish.manifests(spark, path)] == [5, 6]
    assert state(spark, path) == third and state(spark, path, as_of=5) == after
    publish.publish_history(batch(spark, ("d", "1", 1)), path, SPEC, run(6), "b7", parts=2)
    publish.vacuum_published(spark, path)
    assert state(spark, path) == [*third, ("d", "1", 1, "Y")]
    assert [(m.version, m.form) for m in publish.manifests(spark, path)] == [(7, "base")]
    assert publish.vacuum_published(spark, path) == []
    assert [r["at"].day for r in publish.published_versions(spark, path).collect()] == [7]


def test_a_vacuum_that_died_leaves_one_of_two_forms(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for n in range(3):
        publish.publish_history(batch(spark, ("a", str(n), n)), path, SPEC, run(n), f"b{n}", parts=1)
    before = state(spark, path)
    monkeypatch.setattr(commits, "remove", lambda *_: (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError, match="died"):
        publish.vacuum_published(spark, path)
    monkeypatch.undo()
    assert state(spark, path) == before
    publish.vacuum_published(spark, path)
    assert state(spark, path) == before


def test_two_writers_are_noticed(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish_history(batch(spark, ("a", "1", 1)), path, SPEC, run(0), "b1", parts=1)
    publish._write_manifest(spark, path, [], publish.CHANGE, [("current", 0, "elsewhere", 1)])
    with pytest.raises(ValueError, match="two writers"):
        publish.manifests(spark, path)


def test_a_batch_reads_few_manifests_however_old_the_table(spark, tmp_path):
    path, parts = str(tmp_path / "t"), 4
    schema = publish.published_schema(batch(spark), SPEC)
    most = 0
    for n in range(60):
        found = publish.manifests(spark, path)
        most = max(most, publish._entries(spark, path, publish._since(found, publish.FULL, publish.BASE), "current").count())
        fresh = [("current", n % parts, f"{path}/batches/b{n}/part", 1), ("closed", None, f"{path}/batches/b{n}/closed", 1)]
        publish._commit(spark, path, found, fresh, schema, run(n))
    found = publish.manifests(spark, path)
    assert most <= parts + publish.FULL_EVERY
    assert {f.split("/")[-2] for f in publish._folders(publish._current(spark, path, found))} == {"b56", "b57", "b58", "b59"}
    assert len(publish._closed_folders(spark, path, found)) == 60


def test_an_unchanged_extract_shuffles_keys_and_markers_only(spark, tmp_path):
    path = str(tmp_path / "t")
    wide = batch(spark, *[(f"k{i}", "a", 1) for i in range(100)]).withColumn("text", F.repeat(F.lit("x"), 1000))
    wide.write.parquet(str(tmp_path / "s"))
    staged = spark.read.parquet(str(tmp_path / "s"))
    publish.publish_history(staged, path, SPEC, run(0), "b1", parts=2)
    written = commits.folders(spark, f"{path}/batches")
    done = publish.publish_history(staged, path, SPEC, run(1), "b2", parts=2)
    assert (done.unchanged, done.stale, done.versions, done.previous, done.rejects) == (100, 0, 0, 100, None)
    assert commits.folders(spark, f"{path}/batches") == written
    assert publish.read_refused(spark, done).count() == 0
    current = publish.read_current(spark, path, done.schema)
    plan = publish.changed_keys(current, staged, SPEC, F.lit(0))._jdf.queryExecution().toString()
    assert plan.count("ReadSchema: struct<k:string,h:string>") == 2


def test_only_parts_with_changes_are_rewritten_and_old_rows_copied(spark, tmp_path):
    path = str(tmp_path / "t")
    part = F.substring("k", 1, 1).cast("int")
    everything = [(f"{i % 4}{i}", "a", 1) for i in range(40)]
    publish.publish_history(batch(spark, *everything), path, SPEC, run(0), "b1", part=part)
    changed = [(k, "b", 2) if k in ("11", "337") else (k, h, v) for k, h, v in everything]
    done = publish.publish_history(batch(spark, *changed), path, SPEC, run(1), "b2", part=part)
    assert (done.updated, done.unchanged, done.inserted, done.previous) == (1, 39, 0, 40)  # 337 is no key of it
    assert {p.parent.name for p in (tmp_path / "t" / "batches").glob("b2-*/kind=*/part=*/*.parquet")} == {"part=1"}
    assert len(state(spark, path)) == 41


def test_an_older_repeat_of_the_current_row_is_unchanged_not_stale(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish_history(batch(spark, ("a", "x", 5), ("b", "x", 5)), path, SPEC, run(0), "b1", parts=1)
    done = publish.publish_history(batch(spark, ("a", "x", 4), ("a", "y", 6), ("b", "z", 3), ("b", "x", 9)), path, SPEC, run(1), "b2", parts=1)
    assert (done.updated, done.unchanged, done.stale) == (1, 2, 1)
    assert state(spark, path) == [("a", "x", 1, "N"), ("a", "y", 2, "Y"), ("b", "x", 1, "Y")]
