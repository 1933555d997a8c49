"""The query registry and the inputs queries share.

Inputs are derived from whole tables by projections that Spark and DuckDB both
understand, so a query and its SQL start from the same text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from landflow.session import configure, size_shuffles

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    operators: str
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, operators: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query under ``name``; ``operators`` lists the survey ids it covers."""

    def add(build: Build) -> Build:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(size_shuffles(configure(spark), sf_dir), sf_dir)

        if name in REGISTRY:
            raise ValueError(f"query registered twice: {name}")
        REGISTRY[name] = Query(name, operators, run, sql)
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utc(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


# ------------------------------------------------------------------ shared inputs

#: Orders as untidy text, the way a file delivers them.
DIRTY_ORDERS = [
    """CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 89 = 0 THEN NULL
            WHEN o_orderkey % 83 = 0 THEN concat('x', CAST(o_orderkey AS STRING))
            ELSE CAST(o_orderkey AS STRING) END AS order_id""",
    "CASE WHEN o_custkey % 71 = 0 THEN '  ' ELSE concat(' ', CAST(o_custkey AS STRING), ' ') END AS customer_id",
    "CASE WHEN o_custkey % 59 = 0 THEN NULL ELSE o_orderstatus END AS status",
    "concat('$', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)) AS price",
    """CASE WHEN o_orderkey % 53 = 0 THEN '0' WHEN o_orderkey % 47 = 0 THEN 'Not available'
            WHEN o_orderkey % 43 = 0 THEN '31/12/1999' WHEN o_orderkey % 41 = 0 THEN ''
            ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS order_date""",
    """CASE WHEN o_orderkey % 37 = 0 THEN 'bad time' WHEN o_orderkey % 31 = 0 THEN NULL
            ELSE concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 10:20:30') END AS modified""",
    "o_orderpriority AS priority",
]


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*DIRTY_ORDERS)


DIRTY_ORDERS_SQL = "dirty AS (SELECT " + ", ".join(DIRTY_ORDERS) + " FROM orders)"

#: Order lines as two extracts, split by ship date; keys recur within and across them.
SPLIT_DAY = "1998-06-30"
RUN_1, RUN_2 = utc("2024-03-01 06:00:00"), utc("2024-03-02 06:00:00")
LINE_KEYS = ["order_id", "line_no"]
LINE_EXTRACT = [
    "lpad(CAST(l_orderkey AS STRING), 10, '0') AS order_id",
    "CAST(l_linenumber AS STRING) AS line_no",
    "l_returnflag AS return_flag",
    "l_linestatus AS line_status",
    "CAST(l_quantity AS DECIMAL(18,2)) AS quantity",
    "CAST(l_extendedprice AS DECIMAL(18,2)) AS price",
    "CAST(l_shipdate AS TIMESTAMP) AS modified",
]
LINE_EXTRACT_SQL = (
    "extract AS (SELECT " + ", ".join(LINE_EXTRACT) + ", "
    f"CASE WHEN l_shipdate < DATE '{SPLIT_DAY}' THEN 1 ELSE 2 END AS extract_no, "
    "sha256(concat_ws('|', l_returnflag, l_linestatus)) AS record_hash FROM lineitem), "
    "latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER ("
    "PARTITION BY extract_no, order_id, line_no ORDER BY modified DESC NULLS LAST, return_flag NULLS FIRST, "
    "line_status NULLS FIRST, quantity NULLS FIRST, price NULLS FIRST) AS rn FROM extract) WHERE rn = 1), "
    "first_extract AS (SELECT * EXCLUDE (extract_no) FROM latest WHERE extract_no = 1), "
    "second_extract AS (SELECT * EXCLUDE (extract_no) FROM latest WHERE extract_no = 2)"
)
