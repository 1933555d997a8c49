from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from landflow.config import ConfigError
from landflow.functions import clean, enrich


def values(spark, texts, build):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(build(F.col("c"))).collect()]


@pytest.mark.parametrize(
    "build, texts, expected",
    [
        (clean.strip_nbsp, ["\u00a0a\u00a0 b", None, ""], ["a b", None, ""]),
        (clean.trim_spaces, ["  a ", "\ta", None], ["a", "\ta", None]),
        (clean.strip_control_chars, ["a\x00b\x1f\x7f\x9f", "é ok", None], ["ab", "é ok", None]),
        (clean.strip_symbols, ["$1,234@#", "", None], ["1234", "", None]),
        (lambda c: clean.strip_symbols(c, {"#": "1"}), ["#7$"], ["17$"]),
        (clean.digits_only, ["ab12cd34", "none", None], ["12", "", None]),
        (clean.numeric_chars_only, ["USD -1.50x", None], ["-1.50", None]),
        (clean.edi_cleanup, ["~ 512~", "712", "12", None], ["00512", "00712", "12", None]),
        (clean.placeholder_to_blank, ["0", "00", "Not available", "X", None], [None, "00", None, None, None]),
        (clean.blank_to_null, ["  ", "a", None], [None, "a", None]),
        (clean.null_to_blank, [None, "a"], ["", "a"]),
        (clean.cast_long, ["12", " 12 ", "1x", "1.5", "", None], [12, 12, None, None, None, None]),
        (clean.cast_double, ["1.5", "x", None], [1.5, None, None]),
        (lambda c: clean.fill_null(clean.cast_long(c), 0), ["x", "3"], [0, 3]),
        (clean.strip_leading_zeros, ["00120", "000", "a0", None], ["120", "", "a0", None]),
        (clean.normalized_key, [" a ", None, ""], ["a", "", ""]),
        (clean.month_label, ["May 2024 plan", "May", None], ["May2024", None, None]),
        (
            lambda c: clean.excel_serial_date(c, ["-", clean.SERIAL_OPEN_END]),
            ["1", "45352", "45352.9", "-", "2958465", "x", None],
            [dt.date(1899, 12, 31), dt.date(2024, 3, 1), dt.date(2024, 3, 1), None, None, None, None],
        ),
        (
            lambda c: clean.standardize_date(c, "yyyy-MM-dd"),
            ["2024-03-01", "2024-3-1", "", "01/03/2024", None],
            [dt.date(2024, 3, 1), None, None, None, None],
        ),
        (
            enrich.calendar_quarter_text,
            ["2024-01-31", "2024-12", "2024-1", None, "2024-xx-01"],
            ["2024-Q1", "2024-Q4", None, None, None],
        ),
        (enrich.type_priority, ["REV", "BACKLOG", "SNI", None], [1, 2, 3, 3]),
    ],
)
def test_text_function(spark, build, texts, expected):
    assert values(spark, texts, build) == expected


def test_scale_decimal(spark):
    assert [str(v) for v in values(spark, ["1.2345", "-0.005"], lambda c: clean.scale_decimal(c, 1).cast("string"))] == ["123.5", "-0.5"]
    assert values(spark, ["1.2345", "2"], lambda c: clean.scale_decimal(c, -1).cast("int")) == [124, 200]


def test_serial_timestamp(spark):
    assert values(spark, ["45352.25"], clean.excel_serial_timestamp)[0].isoformat().startswith("2024-03-01T")


def test_row_hash_of_the_worked_example(spark):
    people = spark.createDataFrame(
        [(1001, "Alice", "Sales", 50000), (1002, "Bob", "IT", 60000), (1002, "Bob", "HR", 65000)],
        "emp_id int, name string, department string, salary int",
    )
    got = {r[0] for r in people.select(enrich.row_hash(people.columns)).collect()}
    texts = ["1001|Alice|Sales|50000", "1002|Bob|IT|60000", "1002|Bob|HR|65000"]
    assert got == {hashlib.sha256(t.encode()).hexdigest() for t in texts}
    assert "ba481a565960b56198c19e454e273348471f221e24cc09428e055d55364ce589" in got


def test_null_safe_hash_tells_shifted_nulls_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    plain = df.select(enrich.row_hash(df.columns)).distinct().count()
    safe = df.select(enrich.row_hash(df.columns, null_safe=True)).distinct().count()
    assert (plain, safe) == (1, 2)


def test_unknown_mapping_is_refused():
    with pytest.raises(ConfigError):
        enrich.mapped_column({"function": "no_such_function", "args": []})
    with pytest.raises(ConfigError):
        enrich.mapped_column({"other": 1})
