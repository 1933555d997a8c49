"""Entity loads, publishing, the regional load and streaming."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from landflow.config import ConfigError, EntityConfig
from landflow.functions.enrich import ProcessorRegistry
from landflow.operators.history import HistorySpec, first_load
from landflow.operators.projection import MissingColumnsError
from landflow.operators.projection import evaluated
from landflow.plans import entity_load, publish, regional
from landflow.streaming import micro_batch as M
from tests.conftest import rows

UTC = dt.timezone.utc
RUNS = [dt.datetime(2024, 3, d, 6, tzinfo=UTC) for d in range(1, 5)]
SPEC = HistorySpec(keys=("k",), change_column="h")


def staged(spark, path, data):
    spark.createDataFrame(data, "k string, h string").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("parts", [1, 5])
def test_publish_is_repeatable(spark, tmp_path, parts):
    root = str(tmp_path / "t")
    one = staged(spark, str(tmp_path / "s1"), [(f"k{i}", "a") for i in range(50)])
    two = staged(spark, str(tmp_path / "s2"), [(f"k{i}", "b" if i % 2 else "a") for i in range(0, 60)])
    publish.publish_history(one, root, SPEC, RUNS[0], "b1", parts=parts)
    done = publish.publish_history(two, root, SPEC, RUNS[1], "b2", parts=parts)
    state = rows(publish.read_published(spark, root, done.schema))
    assert len(state) == 60 + 25
    publish.publish_history(two, root, SPEC, RUNS[1], "b2", parts=parts)
    assert rows(publish.read_published(spark, root, done.schema)) == state


@pytest.mark.parametrize("step", ["batch", "manifest"])
def test_a_batch_that_dies_leaves_the_old_table(spark, tmp_path, monkeypatch, step):
    root, clean_root = str(tmp_path / "t"), str(tmp_path / "clean")
    one = staged(spark, str(tmp_path / "s1"), [(f"k{i}", "a") for i in range(30)])
    two = staged(spark, str(tmp_path / "s2"), [(f"k{i}", "b") for i in range(15)])
    for target in (root, clean_root):
        done = publish.publish_history(one, target, SPEC, RUNS[0], "b1", parts=4)
    before = rows(publish.read_published(spark, root, done.schema))
    publish.publish_history(two, clean_root, SPEC, RUNS[1], "b2", parts=4)

    class Boom(Exception):
        pass

    def boom(*_):
        raise Boom

    monkeypatch.setattr(publish, {"batch": "versions_of_batch", "manifest": "_write_manifest"}[step], boom)
    with pytest.raises(Boom):
        publish.publish_history(two, root, SPEC, RUNS[1], "b2", parts=4)
    monkeypatch.undo()
    assert rows(publish.read_published(spark, root, done.schema)) == before
    done = publish.publish_history(two, root, SPEC, RUNS[1], "b2", parts=4)
    assert rows(publish.read_published(spark, root, done.schema)) == rows(
        publish.read_published(spark, clean_root, done.schema)
    )


def test_publish_makes_versions_of_a_repeated_key(spark, tmp_path):
    """Keys that differ only in blanks are one key; its rows follow one another by the order column."""
    spec = HistorySpec(keys=("k",), change_column="h", order_column="v")
    df = spark.createDataFrame([("a", "x", 1), (" a", "y", 3), ("a ", "z", 2), (None, "n", 1), ("", "m", 2)], "k string, h string, v int")
    done = publish.publish_history(df, str(tmp_path / "t"), spec, RUNS[0], "b1", parts=2)
    got = publish.read_published(spark, str(tmp_path / "t"), done.schema).select("h", "version", "is_current_fg")
    assert rows(got) == [("m", 2, "Y"), ("n", 1, "N"), ("x", 1, "N"), ("y", 3, "Y"), ("z", 2, "N")]
    assert (done.inserted, done.updated, done.versions, done.stale) == (2, 0, 5, 0)
    again = publish.publish_history(df, str(tmp_path / "t"), spec, RUNS[1], "b2", parts=2)
    # the two rows that are current are offered unchanged, the others are older versions
    assert (again.versions, again.unchanged, again.stale) == (0, 2, 3)


def test_the_table_takes_no_column_of_another_type(spark, tmp_path):
    publish.publish_history(spark.createDataFrame([("a", "x", 1)], "k string, h string, v int"), str(tmp_path), SPEC, RUNS[0], "b1")
    with pytest.raises(ValueError, match="another type"):
        publish.publish_history(spark.createDataFrame([("a", "x", "1")], "k string, h string, v string"), str(tmp_path), SPEC, RUNS[0], "b2")


def test_the_table_takes_new_columns(spark, tmp_path):
    publish.publish_history(spark.createDataFrame([("a", "x"), ("b", "x")], "k string, h string"), str(tmp_path), SPEC, RUNS[0], "b1", parts=1)
    done = publish.publish_history(spark.createDataFrame([("a", "y", 7)], "k string, h string, v int"), str(tmp_path), SPEC, RUNS[1], "b2", parts=1)
    got = publish.read_published(spark, str(tmp_path), done.schema).select("k", "h", "v")
    assert rows(got) == [("a", "x", None), ("a", "y", 7), ("b", "x", None)]


def test_publish_rewrites_only_touched_parts(spark, tmp_path):
    root = str(tmp_path / "t")
    part = F.substring("k", 1, 1).cast("int")
    one = staged(spark, str(tmp_path / "s1"), [(f"{i % 5}-{i}", "a") for i in range(50)])
    two = staged(spark, str(tmp_path / "s2"), [("3-3", "b")])
    publish.publish_history(one, root, SPEC, RUNS[0], "b1", part=part)
    done = publish.publish_history(two, root, SPEC, RUNS[1], "b2", part=part)
    written = {p.parent.name for p in (tmp_path / "t" / "batches").glob("b2-*/kind=*/part=*/*.parquet")}
    assert written == {"part=3"}
    assert len(list((tmp_path / "t" / "batches").glob("b2-*/kind=current/part=*/*.parquet"))) == 1
    assert publish.read_published(spark, root, done.schema).count() == 51


def test_read_published_before_any_batch(spark, tmp_path):
    schema = publish.published_schema(spark.createDataFrame([], "k string, h string"), SPEC)
    assert publish.stored_schema(spark, str(tmp_path / "none")) is None
    assert publish.read_published(spark, str(tmp_path / "none"), schema).count() == 0


CONFIG = EntityConfig.from_dict(
    {
        "column_type_map": {"id": "string", "day": "date", "amount": "decimal(18,2)", "seen": "timestamp"},
        "dq_checks": {
            "trim_spaces": True, "remove_special_characters": True, "row_duplicate_check": True,
            "null_notnull_check": True, "decimal_column_normalization": True,
        },
        "notnull_columns": ["id"],
        "primary_key_columns": ["id"],
        "hash_columns": ["id", "day", "amount", "tag"],
        "column_mapping": {"tag": {"lit": "t"}},
    }
)


def raw(spark, data):
    return spark.createDataFrame(data, "id string, day string, amount string, seen string, extra string")


def test_declared_entity(spark):
    data = [
        (" 1 ", "2024-01-02", "1,234.50", "2024-01-02 03:04:05", "x"),
        ("1", "2024-01-02", "1,234.50", "2024-01-02 03:04:05", "x"),
        ("\x002", "not a day", "abc", "nope", "x"),
        ("  ", "2024-01-02", "1", None, "x"),
    ]
    got = entity_load.check_entity(raw(spark, data), CONFIG)
    stamp = dt.datetime(2024, 1, 2, 3, 4, 5)
    clean = sorted((r.id, r.day, str(r.amount), r.seen) for r in got.clean.collect())
    assert clean == [("1", dt.date(2024, 1, 2), "1234.50", stamp)]
    assert sorted(r.reject_reason for r in got.rejects.collect()) == [
        ["amount_type_incorrect", "day_type_incorrect", "seen_type_incorrect"], ["id_null_check_failed"]
    ]
    counts = got.counts.collect()[0]
    assert (counts.landing_count, counts.raw_count, counts.reject_count) == (3, 1, 2)
    hooks = ProcessorRegistry()
    hooks.register("orders", lambda df: df.withColumn("tag", F.lit("hooked")))
    ready = entity_load.prepare_for_publish(got.clean, CONFIG, RUNS[0], "orders", hooks, source_file="f.csv")
    assert {r.tag for r in ready.collect()} == {"hooked"}
    assert ready.select("record_hash").distinct().count() == 1
    keyed = entity_load.check_entity(raw(spark, data), CONFIG, one_per_key_follows=True)
    again = entity_load.prepare_for_publish(keyed.clean, CONFIG, RUNS[0], "orders", hooks, source_file="f.csv")
    assert rows(again) == rows(ready)


def test_declared_entity_refuses_missing_columns_and_missing_checks(spark):
    with pytest.raises(MissingColumnsError):
        entity_load.check_entity(spark.createDataFrame([("1",)], "id string"), CONFIG)
    with pytest.raises(ConfigError):
        entity_load.check_entity(spark.createDataFrame([("1",)], "id string"), EntityConfig())


def test_listed_entity_rejects_surplus_copies(spark):
    config = EntityConfig.from_dict({"required_column_list": ["a", "b"], "int_columns": ["a"]})
    df = spark.createDataFrame([("1", "x"), ("1", "x "), ("1", "x"), ("y", "x")], "a string, b string")
    got = entity_load.check_entity(df, config, "ams")
    assert rows(got.clean) == [("1", "x")]
    reasons = sorted(r.reject_reason[0] for r in got.rejects.collect())
    assert reasons == ["a_integer_format_incorrect", "row level duplicate", "row level duplicate"]
    counts = got.counts.collect()[0]
    assert (counts.landing_count, counts.raw_count, counts.reject_count) == (4, 1, 3)


def test_wide_entity_plans_quickly(spark):
    """Three hundred columns stay one projection."""
    names = [f"c{i}" for i in range(300)]
    config = EntityConfig.from_dict(
        {
            "column_type_map": {n: "string" if i % 3 else "decimal(18,4)" for i, n in enumerate(names)},
            "dq_checks": {"trim_spaces": True, "remove_special_characters": True, "decimal_column_normalization": True},
            "notnull_columns": names[:20],
        }
    )
    df = spark.range(10).select(*[F.concat(F.lit(" 1,"), F.col("id").cast("string")).alias(n) for n in names])
    got = entity_load.check_entity(df, config).clean
    assert got.count() == 10 and len(got.columns) == 300


def curated(spark, data):
    schema = (
        "cp_backlog_sni_revenue string, order_type string, order_create_date string, sales_order_identifier string, "
        "sales_order_line_item_identifier string, source_type string, shipment_date string, delivery_identifier string, "
        "segment string, sum_of_sales_order_base_quantity int, eg_net_revenue int, secured_position_net_usd int, "
        "process_timestamp int, batch_run_dt date"
    )
    day = dt.date(2024, 3, 1)
    return spark.createDataFrame(
        [("REV", "T", "2024-01-01", o, line, "S", None, None, seg, 1, 1, usd, ts, day) for o, line, seg, usd, ts in data],
        schema,
    )


def test_regions_differ_only_in_constants_and_filters(spark):
    calendar = spark.createDataFrame([(dt.date(2024, 3, 1), "2024", "Q2")], "date date, fiscal_year string, fiscal_year_quarter string")
    lines = [
        (order, line, seg, usd, 1)
        for seg in ("Americas ", "Asia Pacific", "EMEA", "Moon")
        for order, line, usd in (("0010", "01", 5), ("0011", "01", -5), ("Grand Total", "1", 1), ("12", "?", 1), (None, "1", 1))
    ]
    got = regional.regional_batch(curated(spark, lines), calendar)
    keys = sorted((r.region, r.region_id, r.sap_order_key, r.fiscal_quarter) for r in got.collect())
    assert keys == [
        ("AMS", 503, "10-1", "Q224"), ("APJ", 502, "10-1", "Q224"),
        ("EMEA", 500, "10-1", "Q224"), ("EMEA", 500, "11-1", "Q224"),
    ]
    only = regional.regional_batch(curated(spark, lines), calendar, regions=regional.REGIONS[:1])
    assert {r.region for r in only.collect()} == {"AMS"}


def test_keys_out_of_scope_go_before_rows_are_reduced(spark):
    """Whole keys go, judged by their normalised text; a null id stays with the blank one until ``admitted``."""
    spec = regional.RegionalSpec()
    lines = [
        ("1", "1", " EMEA", -5, 1), ("1", "1", "EMEA ", 5, 1), ("1", "1", "Moon", 5, 1), ("1", "1", None, 5, 1),
        ("Grand 1", "1", "EMEA", 5, 1), ("?", "1", "EMEA", 5, 1), ("1", "?", "EMEA", 5, 1), (None, "1", "EMEA", 5, 1), ("", "1", "EMEA", 5, 1),
    ]
    rows = curated(spark, lines)
    left = regional.in_scope(rows, spec, regional.REGIONS)
    assert left.columns == rows.columns
    found = [(r.sales_order_identifier, r.segment) for r in left.collect()]
    assert sorted(found, key=str) == sorted([("1", " EMEA"), ("1", "EMEA "), (None, "EMEA"), ("", "EMEA")], key=str)
    assert regional.in_scope(rows.limit(0), spec, regional.REGIONS).count() == 0


def test_evaluated_columns_are_computed_once(spark):
    df = spark.createDataFrame([("a1", None), (None, "b")], "`x (y)` string, z string")
    cleaned = df.select(F.regexp_replace("`x (y)`", "[0-9]", "").alias("x (y)"), "z")
    got = evaluated(cleaned)
    assert got.columns == df.columns and sorted(map(tuple, got.collect()), key=str) == [("a", None), (None, "b")]
    plan = got.filter("`x (y)` <> 'q' AND length(`x (y)`) > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_filtered_rows_do_not_expire_published_ones(spark):
    """Filters come before the comparison, so a rejected update leaves the key's current row alone."""
    calendar = spark.createDataFrame([], "date date, fiscal_year string, fiscal_year_quarter string")
    spec = regional.RegionalSpec()
    before = regional.regional_batch(curated(spark, [("10", "1", "Americas", 5, 1)]), calendar)
    update = regional.regional_batch(curated(spark, [("10", "1", "Americas", -5, 2)]), calendar)
    merged = regional.regional_merge(first_load(before, spec.history, RUNS[0]), update, RUNS[1])
    assert [(r.is_current_fg, r.process_timestamp) for r in merged.collect()] == [("Y", 1)]


def test_file_stream_handles_each_file_once(spark, tmp_path):
    landing, seen = tmp_path / "landing", []
    landing.mkdir()
    for i in range(3):
        (landing / f"f{i}.csv").write_text(f"k,h\nk{i},a\n")
    root = str(tmp_path / "published")

    def handle(batch, epoch):
        seen.append(epoch)
        publish.publish_history(batch, root, SPEC, RUNS[min(epoch, 3)], f"epoch_{epoch}", parts=2)

    def run():
        stream = M.file_stream(
            spark, str(landing), spark.createDataFrame([], "k string, h string").schema, files_per_trigger=1, header="true"
        )
        M.run_available(stream, handle, str(tmp_path / "checkpoint"))

    run()
    assert seen == [0, 1, 2]
    (landing / "f9.csv").write_text("k,h\nk0,b\n")
    run()
    assert seen == [0, 1, 2, 3]
    schema = publish.published_schema(spark.createDataFrame([], "k string, h string"), SPEC)
    got = publish.read_published(spark, root, schema).select("k", "h", "version", "is_current_fg")
    assert rows(got) == [("k0", "a", 1, "N"), ("k0", "b", 2, "Y"), ("k1", "a", 1, "Y"), ("k2", "a", 1, "Y")]


def test_incremental_filter_and_empty_target(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "wm int")
    assert rows(M.incremental_filter(df, df.filter("wm < 3"), "wm")) == [(3,)]
    assert rows(M.incremental_filter(df, df.filter("wm > 9"), "wm")) == [(1,), (2,), (3,)]
