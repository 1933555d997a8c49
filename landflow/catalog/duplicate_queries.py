"""Duplicate rows and keys, reshaping, and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from landflow.catalog.base import query, table
from landflow.functions import enrich
from landflow.operators import duplicates as D
from landflow.operators import reshape
from landflow.operators.report import report_rollup

#: Whole records with copies: every seventh order once more, every third line of these a third time, and one line often.
_COPIED = """SELECT l.* FROM lineitem l UNION ALL SELECT l.* FROM lineitem l WHERE l_orderkey % 7 = 0
    UNION ALL SELECT l.* FROM lineitem l WHERE l_orderkey % 7 = 0 AND l_linenumber % 3 = 0
    UNION ALL SELECT l.* FROM (SELECT * FROM lineitem ORDER BY ALL LIMIT 1) l JOIN lineitem m ON m.l_linenumber = 1"""


def _copied(spark, d):
    rows = table(spark, d, "lineitem")
    again = rows.where("l_orderkey % 7 = 0")
    often = rows.orderBy(*rows.columns).limit(1).join(rows.where("l_linenumber = 1").select(F.lit(1).alias("one")), F.lit(True)).drop("one")
    return rows.unionAll(again).unionAll(again.where("l_linenumber % 3 = 0")).unionAll(often)


@query(
    "duplicate_count", "F1",
    """SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows, count(*) AS duplicate_groups FROM
       (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber, l_returnflag) WHERE n > 1""",
)
def duplicate_count(spark, d):
    return D.duplicate_count(
        table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_returnflag"]
    )


@query("drop_duplicates", "I4", f"SELECT DISTINCT * FROM ({_COPIED})")
def drop_duplicates(spark, d):
    return D.drop_duplicates(_copied(spark, d))


@query("surplus_duplicates", "I3", f"FROM ({_COPIED}) EXCEPT ALL SELECT DISTINCT * FROM ({_COPIED})")
def surplus_duplicates(spark, d):
    return D.surplus_duplicates(_copied(spark, d))


@query("minus_all", "I2", f"FROM ({_COPIED}) EXCEPT ALL FROM lineitem WHERE l_linenumber % 2 = 0")
def minus_all(spark, d):
    """Every second line of an order is taken away once; further copies of it stay."""
    return D.minus_all(_copied(spark, d), table(spark, d, "lineitem").where("l_linenumber % 2 = 0"))


@query(
    "business_key_duplicates", "F2 K7",
    "SELECT l_orderkey, l_linenumber, count(*) AS key_count FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def business_key_duplicates(spark, d):
    return D.business_key_duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def _policy(name: str, kept_sql: str, rejected_sql: str | None) -> None:
    reject = (
        f" UNION ALL SELECT *, 'row level duplicate' AS reject_reason, 'Full Record' AS rejected_column FROM ({rejected_sql})"
        if rejected_sql
        else ""
    )
    sql = f"SELECT *, CAST(NULL AS VARCHAR) AS reject_reason, CAST(NULL AS VARCHAR) AS rejected_column FROM ({kept_sql}){reject}"

    @query(f"row_duplicate_policy_{name}", "K5", sql)
    def build(spark, d):
        policy = D.choose_policy("AMS", {"ams": name})
        kept, rejected = D.row_duplicate_policy(_copied(spark, d), policy)
        empty = F.lit(None).cast("string")
        return kept.withColumns({"reject_reason": empty, "rejected_column": empty}).unionByName(rejected)


_policy("skip", _COPIED, None)
_policy("tolerate", _COPIED, None)
_policy("drop", f"SELECT DISTINCT * FROM ({_COPIED})", None)
_policy("reject", f"SELECT DISTINCT * FROM ({_COPIED})", f"FROM ({_COPIED}) EXCEPT ALL SELECT DISTINCT * FROM ({_COPIED})")


_PRIORITY = """CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END,
    CASE WHEN l_discount <> 0 AND l_tax <> 0 THEN 1 WHEN l_discount = 0 AND l_tax <> 0 THEN 2 ELSE 3 END"""


@query(
    "priority_dedup", "G1 C33",
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_PRIORITY},
        l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
        FROM lineitem) WHERE rn = 1""",
)
def priority_dedup(spark, d):
    kind = enrich.lookup(F.col("l_returnflag"), {"R": "REV", "A": "BACKLOG"}, "OTHER")
    order = [enrich.type_priority(kind), enrich.quantity_priority(F.col("l_discount"), F.col("l_tax"))]
    return D.priority_dedup(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], order)


# ---------------------------------------------------------------- reshape

_MONTHS = [f"M{i:02d}" for i in range(1, 13)]
_PIVOT = "wide AS (SELECT CAST(l_suppkey AS VARCHAR) AS product_id, l_returnflag AS supplier, l_linestatus AS key_figure, " + ", ".join(
    f"CAST(CAST(sum(CASE WHEN month(l_shipdate) = {i} THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS DECIMAL(28,2)) AS VARCHAR) AS M{i:02d}"
    for i in range(1, 13)
) + " FROM lineitem GROUP BY 1, 2, 3)"


def wide_plan(spark, d):
    """Quantity per supplier and month, one column per month, as text with gaps."""
    month = F.month("l_shipdate")
    qty = F.col("l_quantity").cast("decimal(18,2)")
    sums = [
        F.sum(F.when(month == i, qty)).cast("decimal(28,2)").cast("string").alias(name)
        for i, name in enumerate(_MONTHS, start=1)
    ]
    return table(spark, d, "lineitem").groupBy(
        F.col("l_suppkey").cast("string").alias("product_id"),
        F.col("l_returnflag").alias("supplier"),
        F.col("l_linestatus").alias("key_figure"),
    ).agg(*sums)


def _unpivot_sql(label: str, value: str, from_: str = "wide") -> str:
    return (
        f"SELECT * REPLACE (coalesce({value}, '') AS {value}) FROM {from_} "
        f"UNPIVOT INCLUDE NULLS ({value} FOR {label} IN ({', '.join(_MONTHS)}))"
    )


@query("unpivot_months", "I6", f"WITH {_PIVOT} {_unpivot_sql('plan_month', 'plan_quantity')}")
def unpivot_months(spark, d):
    return reshape.unpivot_months(
        wide_plan(spark, d), ["product_id", "supplier", "key_figure"], "plan_month", "plan_quantity", _MONTHS
    )


@query("melt_leading_ids", "I7", f"WITH {_PIVOT} {_unpivot_sql('ref_month', 'safety_target')}")
def melt_leading_ids(spark, d):
    return reshape.melt_leading_ids(wide_plan(spark, d), "ref_month", "safety_target", 3)


_OUTER = """outer_ids AS (SELECT wide.*, product_id || 'a' AS t1, supplier || 'b' AS t2, key_figure || 'c' AS t3,
    'd' AS t4, 'e' AS t5 FROM wide)"""


@query("melt_outer_ids", "I8", f"WITH {_PIVOT}, {_OUTER} {_unpivot_sql('country', 'status', 'outer_ids')}")
def melt_outer_ids(spark, d):
    wide = wide_plan(spark, d).select(
        "*",
        F.concat("product_id", F.lit("a")).alias("t1"),
        F.concat("supplier", F.lit("b")).alias("t2"),
        F.concat("key_figure", F.lit("c")).alias("t3"),
        F.lit("d").alias("t4"),
        F.lit("e").alias("t5"),
    )
    return reshape.melt_outer_ids(wide, "country", "status")


# ---------------------------------------------------------------- report


@query(
    "report_rollup", "F3 D8",
    """SELECT CAST(l_orderkey AS VARCHAR) AS sap_order_key, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS secured_position,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS eg_revenue FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1""",
)
def report_rollup_query(spark, d):
    published = table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("sap_order_key"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_quantity").cast("decimal(18,2)").alias("quantity"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("is_current_fg"),
    )
    return report_rollup(
        published, ["sap_order_key"], {"secured_position": "price", "eg_revenue": "quantity"}
    )
