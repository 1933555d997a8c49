"""Readers, sinks and admission on real files."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from landflow.catalog import file_queries
from landflow.config import EntityConfig
from landflow.operators import admission as A
from landflow.operators import audit
from landflow.sources import readers, sinks
from tests.conftest import rows

UTC = dt.timezone.utc


def write(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return path


def test_read_delimited_keeps_text(spark, tmp_path):
    write(tmp_path, "a.csv", 'x,y\n001,"a,b"\nnan,NaT\n,\n')
    got = readers.read_delimited(spark, str(tmp_path), ["id", "txt"])
    assert rows(got) == [("", ""), ("", ""), ("001", "a,b")]


def test_latin1_region(spark, tmp_path):
    write(tmp_path, "a.xls", "h1\th2\ncafé\t1\n", "latin-1")
    assert rows(readers.read_tsv_legacy(spark, str(tmp_path), ["n", "v"], region="APJ")) == [("café", "1")]


@pytest.fixture
def small_blocks(spark):
    """Blocks of a few hundred bytes, so that one file spans many."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_line_numbers_across_blocks(spark, tmp_path, small_blocks):
    for name, count in (("a.txt", 500), ("b.txt", 7), ("c.txt", 1)):
        write(tmp_path, name, "".join(f"{i},{'x' * (i % 40)}\n" for i in range(count)))
    got = readers.numbered_lines(spark, str(tmp_path))
    assert got.select(F.max("line")).collect()[0][0] == 499
    wrong = got.filter(F.split("value", ",")[0].cast("bigint") != F.col("line"))
    assert wrong.count() == 0
    counts = got.select(F.element_at(F.split("path", "/"), -1).alias("f"), "line_count").distinct()
    assert rows(counts) == [("a.txt", 500), ("b.txt", 7), ("c.txt", 1)]


@pytest.mark.parametrize("trailer, first, last", [(0, 0, 299), (-2, 0, 297), (3, 0, 2)])
def test_header_and_trailer_rows(spark, tmp_path, small_blocks, trailer, first, last):
    body = "".join(f"{i};v{i}\n" for i in range(300))
    write(tmp_path, "a.csv", "title\nsecond title\nid;v\n" + body)
    config = EntityConfig(
        required_column_list=("id", "v"), delimiter=";", header_row_number_to_select=2, remove_trailer_rows=trailer
    )
    got = readers.read_entity(spark, str(tmp_path), config)
    ids = sorted(int(r.id) for r in got.collect())
    assert ids == list(range(first, last + 1))
    assert {r[0] for r in got.select(readers.SOURCE_FILE).distinct().collect()} == {"a.csv"}


def test_empty_rows_are_dropped(spark, tmp_path):
    write(tmp_path, "a.csv", "x,y\n1,2\n , \n,\n3,\n")
    got = readers.read_entity(spark, str(tmp_path), EntityConfig(required_column_list=("x", "y")))
    assert rows(got.select("x", "y")) == [("1", "2"), ("3", "")]


def test_admission_of_real_files(spark, tmp_path):
    def land(name, text, size=None, manifest=True):
        path = write(tmp_path, name, text)
        if manifest:
            write(tmp_path, f"metadata_{name.split('.')[0]}.csv", f"\n{name}|{len(text) if size is None else size}\n")
        return path

    stamp = iter(range(20240301060000, 20240301070000))
    land(f"ORDERS_EU_{next(stamp)}.csv", "a,b\n1,2\n")
    land(f"ORDERS_US_{next(stamp)}.csv", "a,b\n1,2\n", size=99)
    land(f"ORDERS_JP_{next(stamp)}.xlsx", "a,b\n1,2\n")
    land(f"ORDERS_CN_{next(stamp)}.xlsx", "a,b\n", size=1)
    land(f"ORDERS_BR_{next(stamp)}.csv", "")
    land(f"ORDERS_IN_{next(stamp)}.csv", "a,b\n", manifest=False)
    land(f"STRAY_{next(stamp)}.csv", "a,b\n")
    late = land(f"ORDERS_ZA_{next(stamp)}.csv", "a,b\n")
    land(f"ORDERS_KR_{next(stamp)}.csv", "a,b\n")
    land(f"ORDERS_KR_{next(stamp)}.csv", "a,b\n")
    land(f"LOST_ORDERS_{next(stamp)}.csv", "a,b\n")
    now = dt.datetime.now(UTC)
    os.utime(late, (now.timestamp() - 3 * 3600,) * 2)

    data, _ = A.split_listing(readers.list_landing(spark, str(tmp_path)))
    manifest = readers.read_manifest(spark, str(tmp_path))
    header = readers.header_columns(spark, str(tmp_path))
    judged = A.admission_verdict(
        data, manifest, now, {"ORDERS": "csv"}, prefixes=["ORDERS", "STRAY"], header_columns=header
    )
    got = sorted((r.base_name, r.status, r.reason) for r in judged.collect())
    assert got == [
        ("LOST_ORDERS", "REJECTED", "File naming pattern check failed"),
        ("ORDERS_BR", "REJECTED", "File size check failed (empty file)"),
        ("ORDERS_CN", "REJECTED", "File size and extension are not matched"),
        ("ORDERS_EU", "ACCEPTED", None),
        ("ORDERS_IN", "AWAIT", "No metadata file yet"),
        ("ORDERS_JP", "REJECTED", "File extension is not matched"),
        ("ORDERS_KR", "REJECTED", "Duplicate check failed"),
        ("ORDERS_KR", "REJECTED", "Duplicate check failed"),
        ("ORDERS_US", "REJECTED", "File size is not matched"),
        ("ORDERS_ZA", "REJECTED", "File timeliness/SLA check failed"),
        ("STRAY", "AWAIT", "No entity configured"),
    ]
    by_base = A.admission_verdict(
        data, manifest, now, {"ORDERS": "csv"}, match_by="base", hold_unmatched=False
    ).filter("base_name = 'ORDERS_IN'").collect()[0]
    assert by_base.reason == "Matching metadata file check failed"


def test_manifests_that_contradict_one_another(spark):
    """One manifest fits the file, but a second one of the same name declares another size or none."""
    now = dt.datetime(2024, 3, 1, 6, 30)
    files = [f"ORDERS_{c}_20240301060000.csv" for c in ("AA", "BB", "CC", "DD")]
    data = spark.createDataFrame([(f, f, 10, now) for f in files], "path string, file_name string, length long, modificationTime timestamp")
    stems = [f.removesuffix(".csv") for f in files]
    sizes = [(stems[0], 10), (stems[0], 11), (stems[1], 10), (stems[1], 10), (stems[2], 10), (stems[2], None), (stems[3], 11)]
    names = [(f"{A.MANIFEST_PREFIX}{s}.csv", size) for s, size in sizes]
    manifest = spark.createDataFrame(names, "manifest_name string, declared_size long")
    judged = A.admission_verdict(data, manifest, now, {"ORDERS": "csv"}, prefixes=["ORDERS"])
    both = "Metadata files declare different sizes"
    got = {r.file_name[7:9]: r.reason for r in judged.collect()}
    assert got == {"AA": both, "BB": None, "CC": both, "DD": "File size is not matched"}


def test_lines_of_many_files_go_to_many_tasks(spark):
    lines = spark.range(300).selectExpr("id % 10 AS file", "-id AS rank")
    spread = file_queries._one_task_a_file(lines).withColumn("task", F.spark_partition_id())
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.file, r.task) for r in spread.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    assert len(got) == 10 and len({task for _, task in got}) > 1


def test_entity_key_falls_back_to_the_stem(spark):
    df = spark.createDataFrame([("AMS_Fusion_x_20240301060000.csv",), ("Some_Plan_20240301060000.csv",), ("short.csv",)], "n string")
    got = [r[0] for r in df.select(A.entity_key(F.col("n"), ["Fusion"])).collect()]
    assert got == ["Fusion", "Some_Plan", ""]


def test_rejects_of_other_entities_survive_a_rerun(spark, tmp_path):
    path = str(tmp_path / "rejects")
    frame = spark.createDataFrame([(1,), (2,)], "i int")
    sinks.write_rejects(frame, path, "a", dt.date(2024, 3, 1))
    sinks.write_rejects(frame, path, "b", dt.date(2024, 3, 1))
    sinks.write_rejects(frame.limit(1), path, "a", dt.date(2024, 3, 1))
    counts = spark.read.parquet(path).groupBy("entity").count()
    assert rows(counts) == [("a", 1), ("b", 2)]


def test_audit_record_layout(spark, tmp_path):
    record = audit.audit_record(spark, {"batchid": "b", "errormessage": "e" * 3000, "landingcount": 3})
    assert record.columns == audit.AUDIT_COLUMNS and len(record.columns) == 36
    assert len(record.collect()[0].errormessage) == 2000
    sinks.append_audit(record, str(tmp_path / "audit"))
    sinks.append_audit(record, str(tmp_path / "audit"))
    assert spark.read.parquet(str(tmp_path / "audit")).count() == 2


def test_batch_ids(spark):
    day = F.lit(dt.date(2024, 3, 1))
    got = spark.range(1).select(audit.batch_id("EMEA", day), audit.batch_id("WW", day)).collect()[0]
    assert tuple(got) == ("EMEABatch_20240301", "WW_Batch_20240301")


# ---------------------------------------------------------------- landing source and headers


def test_first_lines_are_read_without_the_rest(tmp_path):
    """Only the pieces up to the line break are fetched, however long the file."""
    from pyarrow import fs

    from landflow.sources import landing

    path = write(tmp_path, "big.csv", "id,v\r\n" + "x" * 3_000_000)
    read = []

    class Counting:
        def open_input_stream(self, name):
            stream = fs.LocalFileSystem().open_input_stream(name)

            class Stream:
                def __enter__(self):
                    return self

                def __exit__(self, *_):
                    stream.close()

                def read(self, n):
                    read.append(n)
                    return stream.read(n)

            return Stream()

    assert landing.first_line(Counting(), str(path)) == b"id,v"
    assert sum(read) == landing.PIECE


def test_listing_has_a_partition_for_each_folder_and_keeps_empty_files(spark, tmp_path):
    for folder in ("a", "a/deep", "b", "_hidden"):
        (tmp_path / folder).mkdir()
        for name in ("one.csv", "two.csv", "none.csv", ".crc", "x.txt"):
            write(tmp_path / folder, name, "" if name == "none.csv" else "id,v\n1,2\n")
    got = readers.list_landing(spark, str(tmp_path), "*.csv")
    assert got.rdd.getNumPartitions() == 4  # the root and three folders
    found = got.select(F.regexp_extract("path", "([^/]+/[^/]+)$", 1), "length", F.col("modificationTime").isNotNull())
    want = [(f"{d}/{n}", 0 if n == "none.csv" else 9, True) for d in ("a", "deep", "b") for n in ("one.csv", "two.csv", "none.csv")]
    assert rows(found) == sorted(want)
    assert rows(readers.list_landing(spark, f"{tmp_path}/[ab]", "*.csv", slices=3).select("length")) == [(0,)] * 3 + [(9,)] * 6
    assert readers.list_landing(spark, f"{tmp_path}/a/*.txt").count() == 1
    assert readers.list_landing(spark, f"{tmp_path}/a/one.csv").count() == 1
    with pytest.raises(Exception, match="FileNotFound"):
        readers.list_landing(spark, f"{tmp_path}/gone").count()


def test_header_names_of_quoted_and_latin_headers(spark, tmp_path):
    write(tmp_path, "a.csv", 'id;"a;b";"say ""x"""\n1;2;3\n', "latin-1")
    write(tmp_path, "b.csv", "é;ü", "latin-1")
    write(tmp_path, "c.csv", "")
    got = readers.header_names(spark, str(tmp_path), ";", "ISO-8859-1").select("header")
    assert sorted(r[0] for r in got.collect()) == [[], ["id", "a;b", 'say "x"'], ["é", "ü"]]


def test_columns_are_found_by_name(spark, tmp_path):
    write(tmp_path, "a.csv", 'price,order_id,customer\n5,o1,"c,1"\n6,o2\n7,o3,c3,more\n')
    write(tmp_path, "b.csv", "order_id,price,customer\no4,8,c4\n")
    write(tmp_path, "c.csv", "order_id,,customer,price,Unnamed: 4\no5,z,c5,9,y\n")
    write(tmp_path, "d.csv", " order_id , customer\no6,c6\n")
    config = EntityConfig(required_column_list=("order_id", "price", "customer"))
    got = readers.read_entity(spark, str(tmp_path), config)
    shown = got.select("order_id", "price", "customer", F.col(readers.MALFORMED).isNotNull().alias("bad"), F.col(f"{readers.HEADER_FAULTS}.reason").alias("faults"))
    assert sorted(map(tuple, shown.collect()), key=str) == sorted(
        [
            ("o1", "5", "c,1", False, []), ("o2", "6", "", True, []), ("o3", "7", "c3", True, []), ("o4", "8", "c4", False, []),
            ("o5", "9", "c5", False, []), ("o6", "", "c6", False, ["price_missing_in_header"]),
        ],
        key=str,
    )
    few = readers.read_entity(spark, str(tmp_path / "c.csv"), EntityConfig(required_column_list=("order_id", "customer"), columns_to_select=3))
    assert [tuple(r[:2]) for r in few.collect()] == [("o5", "c5")]
    assert few.first()[readers.HEADER_FAULTS] == []
    forced = readers.read_entity(spark, str(tmp_path / "a.csv"), EntityConfig(required_column_list=("x", "y", "z"), force_column_names=True))
    assert ("5", "o1", "c,1") in [tuple(r[:3]) for r in forced.collect()]


def test_header_in_a_later_line_is_resolved_too(spark, tmp_path, small_blocks):
    body = "".join(f"v{i};{i}\n" for i in range(200))
    write(tmp_path, "a.csv", "title\nv;id\n" + body + "total\n")
    config = EntityConfig(required_column_list=("id", "v"), delimiter=";", header_row_number_to_select=1, remove_trailer_rows=-1)
    got = readers.read_entity(spark, str(tmp_path), config).select("id", "v")
    assert rows(got) == sorted(((str(i), f"v{i}") for i in range(200)), key=str)


def test_lines_are_numbered_from_one_scan(spark, tmp_path, small_blocks):
    """The text is read once, by the write of the lines; the plan over it reads what was written."""
    write(tmp_path, "a.txt", "".join(f"{i}\n" for i in range(300)))
    plan = readers.numbered_lines(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "FileScan text" not in plan and "FileScan parquet" in plan


def test_fields_of_a_line(spark):
    lines = ['a,b', ',', '', '"x,""y""",z', 'a"b,c', '"ab"c,d', ',,x', '"open,b', "é,😀"]
    got = spark.createDataFrame([(x,) for x in lines], "v string").select(readers.fields_of(F.col("v"), ","))
    want = [["a", "b"], ["", ""], [""], ['x,"y"', "z"], ['a"b', "c"], ['"ab"c', "d"], ["", "", "x"], ['"open', "b"], ["é", "😀"]]
    assert [r[0] for r in got.collect()] == want


def test_no_task_gets_all_lines_of_a_file(spark):
    """configured_file_verdict, stream_entity: joined by path, a file's lines were de-duplicated in one task."""
    lines = spark.range(2000).select(F.lit("one").alias("path"), F.concat(F.col("id"), F.lit(",x")).alias("value"))
    heads = spark.createDataFrame([("one", ["b", "a"])], "path string, header array<string>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        found = readers.by_header(lines, heads, ["a", "b"]).drop(readers.HEADER_FAULTS).distinct()
        share = found.groupBy(F.spark_partition_id().alias("task")).count()
        assert found.count() == 2000
        assert max(r["count"] for r in share.collect()) < 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
