from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from landflow.functions.enrich import row_hash
from landflow.operators import history as H
from landflow.operators import joins, snapshot
from tests.conftest import rows

UTC = dt.timezone.utc
DAY1, DAY2, DAY3 = (dt.datetime(2024, 3, d, tzinfo=UTC) for d in (1, 2, 3))
SPEC = H.HistorySpec(keys=("k",), change_column="h")


def batch(spark, data):
    return spark.createDataFrame(data, "k string, h string, v int")


def current_of(merged):
    return H.split_merged(merged, SPEC)[0]


def test_worked_example(spark):
    schema = "emp_id int, name string, department string, salary int"
    columns = ["emp_id", "name", "department", "salary"]
    spec = H.versioned_spec(["emp_id"], "hash_key")

    def load(data):
        return spark.createDataFrame(data, schema).withColumn("hash_key", row_hash(columns))

    first = load([(1001, "Alice", "Sales", 50000), (1002, "Bob", "IT", 60000)])
    merged = H.merge_history(H.first_load(first, spec, DAY1), load([(1002, "Bob", "HR", 65000)]), spec, DAY2)
    got = {(r.emp_id, r.version): (r.department, r.is_active, r.end_ts) for r in merged.collect()}
    closed_at = DAY2.replace(tzinfo=None)
    assert got == {
        (1001, 1): ("Sales", True, None),
        (1002, 1): ("IT", False, closed_at),
        (1002, 2): ("HR", True, None),
    }


def test_cases_of_a_merge(spark):
    first = batch(spark, [("same", "a", 1), ("changed", "a", 1), ("untouched", "a", 1), (" pad ", "a", 1), (None, "a", 1)])
    second = batch(spark, [("same", "a", 2), ("changed", "b", 2), ("new", "a", 2), ("pad", "b", 2), ("", "b", 2)])
    merged = H.merge_history(H.first_load(first, SPEC, DAY1), second, SPEC, DAY2)
    got = {(r.k, r.version, r.is_current_fg): r.v for r in merged.collect()}
    assert got == {
        ("same", 1, "Y"): 1, ("untouched", 1, "Y"): 1, ("new", 1, "Y"): 2,
        ("changed", 1, "N"): 1, ("changed", 2, "Y"): 2,
        (" pad ", 1, "N"): 1, ("pad", 2, "Y"): 2,
        (None, 1, "N"): 1, ("", 2, "Y"): 2,
    }


def test_merging_a_batch_again_changes_nothing(spark):
    first = batch(spark, [("a", "1", 1), ("b", "1", 1), ("n", None, 1)])
    second = batch(spark, [("a", "2", 2), ("b", "1", 2), ("n", None, 2), ("m", None, 2)])
    once = current_of(H.merge_history(H.first_load(first, SPEC, DAY1), second, SPEC, DAY2))
    again = H.merge_history(once, second, SPEC, DAY3)
    assert rows(again) == rows(once)


def test_older_rows_are_ignored_when_ordered(spark):
    spec = H.HistorySpec(keys=("k",), change_column="h", order_column="v")
    first = H.first_load(batch(spark, [("a", "new", 5), ("b", "old", 5)]), spec, DAY1)
    merged = H.merge_history(first, batch(spark, [("a", "replayed", 3), ("b", "newer", 6)]), spec, DAY2)
    assert sorted((r.k, r.h, r.is_current_fg) for r in merged.collect()) == [
        ("a", "new", "Y"), ("b", "newer", "Y"), ("b", "old", "N"),
    ]


@pytest.mark.parametrize("partitions", [1, 8])
def test_many_batches_keep_the_invariants(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        current = closed = None
        for day in range(4):
            data = [(f"k{i}", str((i * (day + 3)) % 4), day) for i in range(40) if (i + day) % 3]
            run = DAY1 + dt.timedelta(days=day)
            staging = batch(spark, data)
            if current is None:
                current = H.first_load(staging, SPEC, run)
                continue
            live, shut = H.split_merged(H.merge_history(current, staging, SPEC, run), SPEC)
            current = spark.createDataFrame(live.collect(), live.schema)
            shut = spark.createDataFrame(shut.collect(), shut.schema)
            closed = shut if closed is None else closed.unionByName(shut)
        table = [r.asDict() for r in current.unionByName(closed).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    by_key = {}
    for r in table:
        by_key.setdefault(r["k"], []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r["version"])
        assert [v["version"] for v in versions] == list(range(1, len(versions) + 1))
        assert [v["is_current_fg"] for v in versions] == ["N"] * (len(versions) - 1) + ["Y"]
        for earlier, later in zip(versions, versions[1:]):
            assert earlier["end_date"] == later["start_date"] > earlier["start_date"]
        assert versions[-1]["end_date"] is None


@pytest.fixture(scope="module")
def timeline(spark):
    """A third of all rows belong to one key, and some keys and ties are awkward."""
    hot = spark.range(300).select(F.lit("hot").alias("k"), F.col("id"))
    rest = spark.range(600).select(F.concat(F.lit("k"), F.col("id") % 50), F.col("id"))
    none = spark.range(5).select(F.lit(None).cast("string"), F.col("id"))
    minutes = F.pmod(F.col("id") * 7919, F.lit(20_000))
    return hot.unionAll(rest).unionAll(none).withColumn(
        "ts", F.timestamp_seconds(F.lit(1_700_000_000) + minutes * 60)
    )


def test_bucketed_versions_equal_the_plain_window(timeline):
    plain = H.version_intervals(timeline, ["k"], "ts", ["id"])
    for unit in ("hour", "day", "month"):
        spread = H.version_intervals(timeline, ["k"], "ts", ["id"], F.date_trunc(unit, "ts"))
        assert rows(spread) == rows(plain)


def test_as_of_and_rollback(spark):
    spec = H.versioned_spec(["k"], "h")

    def load(data, source):
        return batch(spark, data).withColumn("source_file", F.lit(source))

    one = H.first_load(load([("a", "1", 1), ("b", "1", 1)], "f1"), spec, DAY1)
    two = H.merge_history(one, load([("a", "2", 2), ("c", "1", 2)], "f2"), spec, DAY2)
    live, shut = H.split_merged(two, spec)
    three = H.merge_history(live, load([("a", "3", 3)], "f3"), spec, DAY3).unionByName(shut)
    assert rows(H.as_of_view(three, DAY1 + dt.timedelta(hours=1)).select("k", "h")) == [("a", "1"), ("b", "1")]
    assert rows(H.as_of_view(three, DAY2).select("k", "h")) == [("a", "2"), ("b", "1"), ("c", "1")]
    assert H.as_of_view(three, DAY1 - dt.timedelta(seconds=1)).count() == 0
    assert rows(H.rollback_to(three, DAY3, spec)) == rows(two)
    assert rows(H.rollback_before_file(three, "f2", spec)) == rows(one)
    changed = H.change_history(three, ["k"]).select("k", "version", "seconds_in_force").collect()
    assert sorted(tuple(r) for r in changed if r.seconds_in_force) == [("a", 1, 86400), ("a", 2, 86400)]


def test_surrogate_ids_are_dense_and_stable(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(1).alias("version"))
    ids = H.surrogate_id(df, ["k", "version"], "row_id", start=11)
    other = H.surrogate_id(df.repartition(3), ["k", "version"], "row_id", start=11)
    assert sorted(r.row_id for r in ids.collect()) == list(range(11, 5011))
    assert rows(ids) == rows(other)


def test_column_defaults_order_and_duplicates(spark):
    df = spark.createDataFrame([("a", "b", 1)], "k string, h string, id int")
    got = H.column_defaults(df, ["k"], ["id", "k", "h"], {"h": F.lit("z"), "extra": F.lit(0)}, surrogate="id")
    assert got.columns == ["k", "h", "extra"] and rows(got) == [("a", "z", 0)]


def test_expire_and_insert_joins_treat_nulls_as_asked(spark):
    target = spark.createDataFrame(
        [("a", "1", "Y"), ("b", None, "Y"), ("c", "1", "N"), ("d", None, "Y"), ("e", "1", "Y")], "k string, m string, is_current_fg string"
    )
    staging = spark.createDataFrame(
        [("a", "1"), ("a", "2"), ("b", "1"), ("c", "2"), ("d", None), ("e", None), ("f", None)], "k string, m string"
    )
    assert [r.k for r in joins.expire_join(target, staging, ["k"], "m", null_safe=False).collect()] == ["a"]
    assert sorted(r.k for r in joins.expire_join(target, staging, ["k"], "m").collect()) == ["a", "b", "e"]
    plain = rows(joins.insert_not_exists(staging, target, ["k"], "m", null_safe=False))
    safe = rows(joins.insert_not_exists(staging, target, ["k"], "m"))
    literal = rows(joins.insert_left_join(staging, target, ["k"], "m", null_safe=False))
    assert literal == [("a", "2"), ("c", "2"), ("f", None)]
    assert rows(joins.insert_left_join(staging, target, ["k"], "m")) == sorted(
        [*literal, ("b", "1"), ("e", None)], key=lambda r: (r[0], r[1] or "")
    )
    twice = target.union(target)  # several current rows of a key return a batch row once
    assert rows(joins.insert_left_join(staging, twice, ["k"], "m")) == rows(joins.insert_left_join(staging, target, ["k"], "m"))
    assert ("d", None) in plain and ("d", None) not in safe and ("f", None) in safe
    assert ("a", "1") not in plain and ("a", "2") in plain and ("c", "2") in plain


def test_merge_join_is_never_a_nested_loop(spark):
    merged = H.merge_history(
        H.first_load(batch(spark, [("a", "1", 1)]), SPEC, DAY1), batch(spark, [("a", "2", 1)]), SPEC, DAY2
    )
    plan = merged._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_snapshots(spark):
    days = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)), (3, dt.date(2024, 1, 2))], "i int, snapshot_date date")
    assert [r.is_latest_fg for r in snapshot.latest_snapshot(days).orderBy("i").collect()] == ["N", "Y", "Y"]
    before = spark.createDataFrame([(1, "Y")], "i int, active_flag string")
    flipped = snapshot.snapshot_flip(before, spark.createDataFrame([(2,)], "i int"))
    assert rows(flipped) == [(1, "N"), (2, "Y")]


def test_a_key_with_most_rows_is_spread_over_all_tasks(spark):
    """Nine rows of ten belong to one key: no task gets much more than its share of them."""
    rows_of = spark.range(8000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"), F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000).alias("ts"), "id")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        got = H.version_intervals(rows_of, ["k"], "ts", ["id"])
        tasks = got.where("k = 'hot'").groupBy(F.spark_partition_id().alias("task")).count().collect()
        plain = Window.partitionBy("k").orderBy("ts", "id")
        want = rows_of.withColumns({"version": F.row_number().over(plain), "end_ts": F.lead("ts").over(plain)})
        assert rows(got) == rows(want)
    finally:
        spark.conf.set(coalesce, before)
    assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 7200 / 2
