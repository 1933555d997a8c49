"""Sort order lines into actual orders, returns and the rest, by decision tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landflow.operators.duplicates import minus_all

# Per region, the (order types, reason codes) that mark an actual order
# and those that mark a return.  No reason codes means any reason.
ACTUAL = {
    "APJ": [
        (("ZOR", "ZI2O"), None),
    ],
    "AMS": [
        (("ZOR", "ZDR", "ZNC", "ZI2O"), None),
    ],
    "EMEA": [
        (("ZOR", "ZI2O"), None),
        (("ZDR",), ("106",)),
    ],
}
RETURNS = {
    "APJ": [
        (("ZCR",), ("4RN", "01", "1", "ZXA", "OS", "N02", "ARS", "ZO2", "1CA", "102")),
        (("ZDR",), ("03", "3", "313")),
        (
            ("ZRE",),
            (
                "4RR", "4CQ", "306", "ZXA", "2", "I14", "I15", "I21", "A08", "308", "N11", "A13", "305",
                "N02", "1CD", "301", "N01", "302", "N09",
            ),
        ),
        (("ZTP",), ("N03", "I55", "N15", "00", "A15", "105", "4CS")),
        (("ZDR", "ZCR"), ("1CC", "4CT", "1CP", "N02")),
        (("ZRE", "ZCR"), ("1CE", "305", "307", "A13", "ACR", "A06", "1CF")),
        (("ZRE", "ZTP"), ("4CT", "102", "4WS")),
        (("ZMRE", "ZTP"), ("4RR", "304", "4RN")),
    ],
    "AMS": [
        (("ZCR",), ("B13", "B17", "B27", "B31", "B37", "100", "B14", "D06")),
        (
            ("ZRE", "ZCR"),
            (
                "B18", "B43", "HS", "ZEF", "301", "307", "B05", "B07", "B10", "B12", "E01", "Z9X", "102",
                "103", "303", "B09", "305", "306", "E55", "001", "308", "B30", "304", "310", "50", "311",
                "B11", "Z9V", "B22", "B03", "B24", "B25", "B06", "I21", "302", "I07", "101", "PER", "B21",
                "050",
            ),
        ),
    ],
    "EMEA": [
        (
            ("ZRE",),
            (
                "405", "406", "410", "411", "412", "420", "421", "415", "460", "414", "C22", "C23", "C24",
                "C25", "C26", "C27", "C28", "C29",
            ),
        ),
        (("ZCR",), ("C30", "C31", "C32", "C37", "C90", "240")),
        (
            ("ZCR", "ZDR"),
            (
                "050", "50", "100", "105", "110", "120", "130", "140", "C17", "C21", "210", "260", "280",
                "C54", "C14", "C45", "410", "405", "406", "411", "412", "420", "421", "415", "460", "414",
                "C22", "C23", "C24", "C25", "C26", "C27", "C28", "C29", "FPN", "C31",
            ),
        ),
        (("ZDR",), ("C32", "C37", "C30", "C90")),
    ],
}


def _matches(
    table: list[tuple[tuple[str, ...], tuple[str, ...] | None]], order_type: Column, reason: Column
) -> Column:
    def clause(types: tuple[str, ...], reasons: tuple[str, ...] | None) -> Column:
        hit = order_type.isin(*types)
        return hit if reasons is None else hit & reason.isin(*reasons)

    return F.coalesce(reduce(or_, (clause(*row) for row in table)), F.lit(False))


def order_class(region: str, order_type: Column, reason: Column) -> Column:
    """``actual``, ``return`` or ``unclassified``; a row that is both counts as actual."""
    key = region.upper()
    return (
        F.when(_matches(ACTUAL[key], order_type, reason), "actual")
        .when(_matches(RETURNS[key], order_type, reason), "return")
        .otherwise("unclassified")
    )


def class_reconcile(df: DataFrame, class_column: str = "order_class") -> DataFrame:
    """Counts per class and whether actual plus return makes up the whole."""
    c = F.col(class_column)
    counts = df.agg(
        F.count(F.lit(1)).alias("raw_count"),
        F.count_if(c == "actual").alias("actual_count"),
        F.count_if(c == "return").alias("return_count"),
    )
    total = F.col("actual_count") + F.col("return_count")
    return counts.withColumn("reconciled", F.col("raw_count") == total)


def unclassified_rows(df: DataFrame, class_column: str = "order_class") -> DataFrame:
    """Rows of neither class: the negated verdict, no set difference needed."""
    return df.filter(F.col(class_column) == "unclassified")


def unclassified_by_difference(df: DataFrame, class_column: str = "order_class") -> DataFrame:
    """The same rows as a multiset difference, for comparison."""
    return minus_all(df, df.filter(F.col(class_column) != "unclassified"))
