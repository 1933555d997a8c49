"""What publishing shuffles and holds: one sort a task, keys as fingerprints, whole rows once."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from landflow import session
from landflow.catalog import run_queries
from landflow.operators import joins
from landflow.operators.history import HistorySpec, versions_of_batch
from landflow.plans import publish
from landflow.session import configure, size_shuffles
from landflow.sources import readers
from tests.conftest import rows

RUN = dt.datetime(2024, 3, 1, 6, tzinfo=dt.timezone.utc)


@pytest.mark.parametrize("order", [None, "v"])
def test_whole_rows_are_sorted_once(spark, order):
    """publish_key_conflicts: windows of three partitionings kept four sorters of a task in memory."""
    batch = spark.createDataFrame([("a", "x", 1)], "k string, h string, v int").union(spark.range(9).selectExpr("string(id)", "'y'", "int(id)"))
    spec = HistorySpec(keys=("k",), change_column="h", order_column=order)
    schema = publish.published_schema(batch, spec)
    merged = versions_of_batch(spark.createDataFrame([], schema), batch, spec, RUN)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_many_changed_keys_are_merged_as_few_are(spark, tmp_path, monkeypatch):
    """entity_published: where most keys change, the rows go through one shuffle instead of three joins."""
    dice = random.Random(5)
    digest = F.sha2(F.col("m").cast("string"), 256)

    def batch(n, v):
        keys = [(str(dice.randrange(300)), dice.randrange(3), v) for _ in range(n)]
        return spark.createDataFrame(keys, "k string, m int, v int").dropDuplicates(["k"]).withColumn("h", F.when(F.col("m") < 2, digest).otherwise("no digest"))

    spec = HistorySpec(keys=("k",), change_column="h")
    batches = [batch(200, n).localCheckpoint() for n in range(3)]
    found = []
    for few in (10**6, -1):
        monkeypatch.setattr(publish, "FEW_KEYS", few)
        path = str(tmp_path / str(few))
        counts = []
        for n, rows_of in enumerate(batches):
            done = publish.publish_history(rows_of, path, spec, RUN + dt.timedelta(hours=n), f"b{n}", parts=3)
            counts.append((done.inserted, done.updated, done.versions, done.unchanged, done.stale, done.conflicts, done.previous))
        found.append((counts, rows(publish.read_published(spark, path))))
    assert found[0] == found[1] and found[0][0][2][1] > 0 and found[0][0][2][3] > 0


@pytest.mark.parametrize("order", [None, "v"])
def test_rows_alone_with_their_key_are_not_shuffled(spark, tmp_path, monkeypatch, order):
    """entity_published, entity_report: whole rows of a large batch were shuffled, though most met no other of their key."""
    spec = HistorySpec(keys=("k", "d"), change_column="h", date_keys=("d",), order_column=order, start_from="at" if order else None)
    day, text = dt.date(2024, 1, 1), "k string, d date, h string, v int, at timestamp, extra string"

    def batch(keys, mark, v, *more):
        plain = [(f"k{n}", day, mark, v, RUN + dt.timedelta(minutes=v), "x") for n in keys]
        return spark.createDataFrame([*plain, *more], text)

    odd = [(None, None, "a", 1, RUN, None), ("  ", dt.date(1900, 1, 1), "b", 2, RUN, None), ("once", None, None, None, None, "y"), (" k7 ", day, "a", 3, RUN, "z")]
    batches = [batch(range(60), "a", 1, *odd), batch(range(50, 120), "b", 5, ("k2", day, "a", 9, RUN, "x")).drop("extra"), batch(range(50, 55), "b", 5)]
    given, found = [], []

    def counted(theirs, offered, *more):
        given.append((theirs.count(), offered.count()))
        return versions_of_batch(theirs, offered, *more)

    monkeypatch.setattr(publish, "versions_of_batch", counted)
    for few in (10**6, 50, -1):
        monkeypatch.setattr(publish, "FEW_KEYS", few)
        path, counts = str(tmp_path / str(few)), []
        for n, rows_of in enumerate(batches):
            done = publish.publish_history(rows_of, path, spec, RUN + dt.timedelta(hours=n), f"b{n}", parts=3)
            counts.append((done.inserted, done.updated, done.versions, done.unchanged, done.stale, done.conflicts, done.previous, rows(publish.read_refused(spark, done))))
        found.append((counts, rows(publish.read_published(spark, path))))
    assert found[0] == found[1] == found[2] and found[0][0][2][:4] == (0, 0, 0, 5)
    # two rows of k7 and two of the blank key; then k50 to k59 and k2 with their current rows.; all rows before
    assert given[-2:] == [(0, 4), (11, 11)]


def test_bits_tell_hashes_apart(spark):
    """entity_published: a hash that was put in is found whatever its bit, and the two sides are all rows."""
    size = 2 * joins.BITMAP
    rows_of = spark.range(4000).select(F.when(F.col("id") > 0, F.xxhash64("id")).alias("x"), "id")
    bits = joins.bit_filter(rows_of.where("id % 3 = 0"), "x", size)
    found, others = (joins.by_bit(rows_of, bits, size, F.coalesce("x", F.lit(0)), hit).collect() for hit in (True, False))
    held = {(r["x"] or 0) & (size - 1) for r in rows_of.collect() if r["id"] % 3 == 0 and r["x"] is not None}
    assert sorted(r["id"] for r in [*found, *others]) == list(range(4000)) and len(found) < 1600
    assert all(((r["x"] or 0) & (size - 1) in held) == hit for side, hit in ((found, True), (others, False)) for r in side)


def test_shares_of_a_shuffle_do_not_grow_with_it(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")}
    try:
        size_shuffles(configure(spark))
        assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "32"
        assert spark.range(1000).repartition("id").rdd.getNumPartitions() == 1
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_shuffles_of_larger_tables_begin_with_more_partitions(spark, tmp_path, monkeypatch):
    """publish_key_conflicts, configured_snapshot, minus_all: a fixed number of partitions grew with the tables."""
    spark.range(5000).write.parquet(str(tmp_path / "t.parquet"))
    name, held = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", sum(f.stat().st_size for f in (tmp_path / "t.parquet").glob("*.parquet"))
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", name)}
    try:
        size_shuffles(configure(spark), str(tmp_path))
        assert spark.conf.get(name) == "32"
        monkeypatch.setattr(session, "TABLE_SHARE", 100)
        size_shuffles(configure(spark), str(tmp_path))
        assert int(spark.conf.get(name)) == -(-held // 100) > 32
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_files_are_named_without_a_pattern_for_each_line(spark, tmp_path):
    """configured_admission: patterns on the path of every line, in four scans, took longer than reading the lines."""
    for n in (1, 5):
        spark.createDataFrame([("id",), (str(n),)], "value string").coalesce(1).write.text(str(tmp_path / f"n={n}"))
    found = run_queries._by_folder(spark, str(tmp_path / "*"))
    assert {r["path"] for r in found.collect()} == {"landing/orders1_20240301053000.csv", "landing/orders5.csv"}
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_plain_paths_are_not_matched_for_each_line(spark, tmp_path):
    """configured_scd2: each line's path was decoded and matched with a pattern, whatever it held."""
    folder = tmp_path / "100% +a"
    spark.createDataFrame([("h",), ("x",)], "value string").coalesce(1).write.text(str(folder))
    found = readers.text_lines(spark, str(folder))
    listed = {r["path"] for r in readers.list_landing(spark, str(folder)).collect()}
    assert {r["path"] for r in found.collect()} == {p for p in listed if p.endswith(".txt")}
    assert "StartsWith(" in found._jdf.queryExecution().optimizedPlan().toString() and "Contains(" in found._jdf.queryExecution().optimizedPlan().toString()
    given = ["file:/a", "file://a", "file:///a", "file:////a/b", "hdfs://n/a", "/a", None]
    paths = spark.createDataFrame([(p,) for p in given], "p string")
    plain = paths.select(readers._same_path(F.col("p")), F.regexp_replace("p", "^file:/+", "file:/"))
    assert all(r[0] == r[1] for r in plain.collect())
