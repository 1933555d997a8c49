"""Column cleaning, typing, enrichment, projections and row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from landflow.catalog.base import DIRTY_ORDERS_SQL, dirty_orders, query, table, utc
from landflow.config import EntityConfig
from landflow.functions import clean, enrich
from landflow.functions.enrich import ProcessorRegistry
from landflow.operators import filters, joins, projection
from landflow.plans import cleaning

# ---------------------------------------------------------------- text cleaning


@query(
    "strip_nbsp", "C6",
    "SELECT c_custkey, replace(concat(chr(160), c_name, chr(160), ' ', c_mktsegment), chr(160), '') AS cleaned FROM customer",
)
def strip_nbsp(spark, d):
    nbsp = F.lit(clean.NBSP)
    raw = F.concat(nbsp, "c_name", nbsp, F.lit(" "), "c_mktsegment")
    return table(spark, d, "customer").select("c_custkey", clean.strip_nbsp(raw).alias("cleaned"))


@query(
    "trim_strings", "C7",
    "SELECT c_custkey, trim(concat('  ', c_name, ' ')) AS name, trim(concat(c_mktsegment, '   ')) AS segment FROM customer",
)
def trim_strings(spark, d):
    df = table(spark, d, "customer").selectExpr(
        "c_custkey", "concat('  ', c_name, ' ') AS name", "concat(c_mktsegment, '   ') AS segment"
    )
    return df.select(
        "c_custkey", clean.trim_spaces(F.col("name")).alias("name"),
        clean.trim_spaces(F.col("segment")).alias("segment"),
    )


@query(
    "strip_control_chars", "C8",
    r"SELECT doc_id, regexp_replace(text, '[\x00-\x1f\x7f-\x{9f}]', '', 'g') AS cleaned FROM documents",
)
def strip_control_chars(spark, d):
    df = table(spark, d, "documents")
    return df.select("doc_id", clean.strip_control_chars(F.col("text")).alias("cleaned"))


@query(
    "strip_symbols", "C9",
    r"""SELECT o_orderkey,
        regexp_replace(concat('$', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '@#,'), '[\$@#,]', '', 'g') AS amount,
        regexp_replace(concat('#', o_orderpriority), '#', '1', 'g') AS marked FROM orders""",
)
def strip_symbols(spark, d):
    amount = F.concat(
        F.lit("$"), F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("@#,")
    )
    marked = F.concat(F.lit("#"), F.col("o_orderpriority"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        clean.strip_symbols(amount).alias("amount"),
        clean.strip_symbols(marked, {"#": "1"}).alias("marked"),
    )


@query(
    "digits_only", "C10",
    """SELECT s_suppkey AS id, regexp_extract(s_name, '[0-9]+') AS digits FROM supplier
       UNION ALL SELECT p_partkey, regexp_extract(concat(p_brand, '-', p_type), '[0-9]+') FROM part""",
)
def digits_only(spark, d):
    s = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), clean.digits_only(F.col("s_name")).alias("digits")
    )
    p = table(spark, d, "part").select(
        "p_partkey", clean.digits_only(F.concat_ws("-", "p_brand", "p_type")).alias("digits")
    )
    return s.unionAll(p)


@query(
    "numeric_chars_only", "C11 C12",
    r"""SELECT o_orderkey,
        regexp_replace(concat('USD ', CAST(CAST(-o_totalprice AS DECIMAL(18,2)) AS VARCHAR), ' net'), '[^0-9.\-]', '', 'g') AS amount,
        replace(concat('1,', CAST(o_custkey AS VARCHAR), ',000'), ',', '') AS plain FROM orders""",
)
def numeric_chars_only(spark, d):
    noisy = F.concat(
        F.lit("USD "), (-F.col("o_totalprice")).cast("decimal(18,2)").cast("string"), F.lit(" net")
    )
    grouped = F.concat(F.lit("1,"), F.col("o_custkey").cast("string"), F.lit(",000"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        clean.numeric_chars_only(noisy).alias("amount"),
        clean.strip_thousands(grouped).alias("plain"),
    )


@query(
    "edi_cleanup", "C13",
    """SELECT o_orderkey, CASE WHEN CAST(o_custkey AS VARCHAR) LIKE '5%' OR CAST(o_custkey AS VARCHAR) LIKE '7%'
       THEN concat('00', CAST(o_custkey AS VARCHAR)) ELSE CAST(o_custkey AS VARCHAR) END AS po_number FROM orders""",
)
def edi_cleanup(spark, d):
    raw = F.concat(F.lit("~ "), F.col("o_custkey").cast("string"), F.lit(" ~"))
    return table(spark, d, "orders").select("o_orderkey", clean.edi_cleanup(raw).alias("po_number"))


@query(
    "placeholder_to_blank", "C14",
    f"""WITH {DIRTY_ORDERS_SQL} SELECT priority, order_date AS raw,
        CASE WHEN order_date IN ('0', '#', '-', 'X', 'TB-ADV', 'Not available') THEN NULL ELSE order_date END AS as_null,
        CASE WHEN order_date = '0' THEN '' ELSE order_date END AS as_blank FROM dirty""",
)
def placeholder_to_blank(spark, d):
    c = F.col("order_date")
    return dirty_orders(spark, d).select(
        "priority", c.alias("raw"),
        clean.placeholder_to_blank(c).alias("as_null"),
        clean.placeholder_to_blank(c, ["0"], blank="").alias("as_blank"),
    )


# ---------------------------------------------------------------- typing


@query(
    "typed_projection", "C15 C16 C17 C20 C21",
    f"""WITH {DIRTY_ORDERS_SQL} SELECT
        CASE WHEN regexp_matches(order_id, '^[0-9]+$') THEN CAST(order_id AS BIGINT) ELSE 0 END AS order_no,
        CASE WHEN trim(customer_id) <> '' THEN CAST(trim(customer_id) AS DOUBLE) END AS customer_no,
        CAST(substr(price, 2) AS DECIMAL(30,15)) AS price,
        CASE WHEN regexp_matches(order_date, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN CAST(order_date AS DATE) END AS order_day,
        CASE WHEN modified <> 'bad time' THEN CAST(modified AS TIMESTAMP) END AS modified_at
        FROM dirty""",
)
def typed_projection(spark, d):
    return dirty_orders(spark, d).select(
        clean.fill_null(clean.cast_long(F.col("order_id")), 0).alias("order_no"),
        clean.cast_double(F.col("customer_id")).alias("customer_no"),
        clean.strip_symbols(F.col("price")).try_cast("decimal(30,15)").alias("price"),
        clean.standardize_date(F.col("order_date"), "yyyy-MM-dd").alias("order_day"),
        clean.standardize_timestamp(F.col("modified"), "yyyy-MM-dd HH:mm:ss").alias("modified_at"),
    )


@query(
    "scale_decimal", "C18",
    """SELECT p_partkey, CAST(round(CAST(p_retailprice AS DECIMAL(18,4)) / 7 * 100, 0) AS DECIMAL(18,0)) AS rounded,
       CAST(ceil(CAST(p_retailprice AS DECIMAL(18,4)) * 100) AS BIGINT) AS raised FROM part""",
)
def scale_decimal(spark, d):
    seventh = F.col("p_retailprice").cast("decimal(18,4)") / 7
    return table(spark, d, "part").select(
        "p_partkey",
        clean.scale_decimal(seventh, 0).cast("decimal(18,0)").alias("rounded"),
        clean.scale_decimal(F.col("p_retailprice"), -1).cast("bigint").alias("raised"),
    )


@query(
    "excel_serial_date", "C19",
    """SELECT o_orderkey, CASE WHEN o_custkey % 61 <> 0 THEN CAST(o_orderdate AS DATE) END AS order_day,
       CAST(o_orderdate AS DATE) + INTERVAL 12 HOUR AS order_noon FROM orders""",
)
def excel_serial_date(spark, d):
    day = F.date_diff(F.col("o_orderdate").cast("date"), F.lit(clean.SERIAL_EPOCH)).cast("string")
    text = (
        F.when(F.col("o_custkey") % 61 != 0, day)
        .when(F.col("o_custkey") % 2 == 0, clean.SERIAL_OPEN_END)
        .otherwise("-")
    )
    noon = F.concat(day, F.lit(".5"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        clean.excel_serial_date(text, ["-", clean.SERIAL_OPEN_END]).alias("order_day"),
        clean.excel_serial_timestamp(noon).alias("order_noon"),
    )


@query(
    "rule_order", "K13 C1 C5",
    f"""WITH {DIRTY_ORDERS_SQL} SELECT
        CASE WHEN regexp_matches(order_id, '^[0-9]+$') THEN CAST(order_id AS BIGINT) ELSE 0 END AS order_id,
        trim(customer_id) AS customer_id, status, substr(price, 2) AS price,
        CASE WHEN order_date IN ('0', 'Not available') THEN NULL ELSE order_date END AS order_date,
        regexp_extract(priority, '[0-9]+') AS priority FROM dirty""",
)
def rule_order(spark, d):
    config = EntityConfig.from_dict(
        {
            "input_file_extension": "csv",
            "required_column_list": ["order_id", "customer_id", "status", "price", "order_date", "modified", "priority"],
            "remove_columns": ["modified"],
            "cast_to_int_columns": ["order_id"],
            "column_cleanup_columns": ["price"],
            "Integer_cleanup_columns": ["priority"],
            "replace_zero_null": ["order_date"],
        }
    )
    return cleaning.clean_columns(dirty_orders(spark, d), config)


# ---------------------------------------------------------------- projections and filters


@query(
    "declared_projection", "C1 C2 C3 C4 C5",
    """SELECT p_partkey AS part_id, p_name AS part_name, p_brand AS brand, p_size AS size FROM part""",
)
def declared_projection(spark, d):
    df = table(spark, d, "part").withColumn("Unnamed: 6", F.lit("junk"))
    named = projection.drop_unnamed(df)
    first = projection.first_n_columns(named, 5)
    renamed = projection.rename_positional(first, ["part_id", "part_name", "brand", "kind", "size"])
    required = projection.select_required(renamed, ["part_id", "part_name", "brand", "kind", "size"])
    return projection.remove_columns(required, ["kind"])


@query(
    "drop_incomplete_rows", "D1 C22 C23",
    f"""WITH {DIRTY_ORDERS_SQL} SELECT order_id, nullif(trim(customer_id), '') AS customer_id,
        coalesce(status, '') AS status, price FROM dirty WHERE order_id IS NOT NULL AND order_id <> ''
        AND modified IS NOT NULL""",
)
def drop_incomplete_rows(spark, d):
    df = filters.drop_null_subset(dirty_orders(spark, d), ["modified"])
    kept = filters.not_null_filter(df, ["order_id"])
    return kept.select(
        "order_id",
        clean.blank_to_null(F.trim("customer_id")).alias("customer_id"),
        clean.null_to_blank(F.col("status")).alias("status"),
        "price",
    )


@query(
    "drop_empty_rows", "D2 D3",
    f"""WITH {DIRTY_ORDERS_SQL} SELECT order_id, customer_id, order_date FROM dirty
        WHERE coalesce(nullif(trim(order_id), ''), nullif(trim(customer_id), ''), nullif(trim(order_date), '')) IS NOT NULL""",
)
def drop_empty_rows(spark, d):
    return filters.drop_empty_rows(
        dirty_orders(spark, d).select("order_id", "customer_id", "order_date")
    )


@query(
    "business_exclusions", "D4 D5 D6",
    """WITH lines AS (SELECT CASE WHEN l_linenumber = 7 THEN concat('Grand Total ', CAST(l_orderkey AS VARCHAR))
             WHEN l_tax = 0.08 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS order_id,
           CASE WHEN l_discount = 0.1 THEN concat(CAST(l_linenumber AS VARCHAR), '?') ELSE CAST(l_linenumber AS VARCHAR) END AS line_id,
           CAST(l_extendedprice * (0.05 - l_discount) AS DECIMAL(18,2)) AS measure,
           concat(r_name, ' ') AS segment
         FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey)
       SELECT order_id, line_id, measure, segment FROM lines
       WHERE trim(segment) = 'ASIA' AND measure >= 0 AND order_id NOT LIKE '%Grand%' AND line_id NOT LIKE '%?%'
       AND order_id NOT LIKE '%?%'""",
)
def business_exclusions(spark, d):
    lines = (
        table(spark, d, "lineitem")
        .join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            """CASE WHEN l_linenumber = 7 THEN concat('Grand Total ', CAST(l_orderkey AS STRING))
               WHEN l_tax = 0.08D THEN NULL ELSE CAST(l_orderkey AS STRING) END AS order_id""",
            """CASE WHEN l_discount = 0.1D THEN concat(CAST(l_linenumber AS STRING), '?')
               ELSE CAST(l_linenumber AS STRING) END AS line_id""",
            "CAST(l_extendedprice * (0.05D - l_discount) AS DECIMAL(18,2)) AS measure",
            "concat(r_name, ' ') AS segment",
        )
    )
    asia = filters.region_filter(lines, "segment", "ASIA")
    return filters.business_exclusions(filters.nonneg_measure(asia, "measure"), "order_id", "line_id")


# ---------------------------------------------------------------- enrichment

_PADDED = [
    "lpad(CAST(l_orderkey AS STRING), 10, '0') AS order_id",
    "lpad(CAST(l_linenumber AS STRING), 6, '0') AS line_id",
    "CAST(l_shipdate AS DATE) AS ship_day",
    "l_returnflag AS kind",
]


@query(
    "enriched_columns", "C24 C25 C26 C27 C29 C31 C32 N1 N2",
    f"""WITH padded AS (SELECT {', '.join(_PADDED)} FROM lineitem)
        SELECT ltrim(order_id, '0') AS order_id, ltrim(line_id, '0') AS line_id, ship_day, kind,
          concat_ws('-', ltrim(order_id, '0'), ltrim(line_id, '0')) AS order_key,
          500 AS region_id, 'WW' AS hierarchy,
          concat(CAST(year(ship_day) AS VARCHAR), '-Q', CAST(quarter(ship_day) AS VARCHAR)) AS fiscal_quarter,
          '' AS spare, concat('Line', kind) AS month_label,
          coalesce(trim(CASE WHEN kind = 'N' THEN NULL ELSE kind END), '') AS kind_key,
          TIMESTAMP '2024-03-01 06:00:00' AS batch_run_dt, 'loader' AS created_by,
          TIMESTAMP '2024-03-01 06:00:00' AS create_dt, 'landing' AS source_nm,
          'lines.csv' AS source_file_name, TIMESTAMP '2024-03-01 06:00:00' AS ingestion_ts, ship_day AS watermark
        FROM padded""",
)
def enriched_columns(spark, d):
    padded = table(spark, d, "lineitem").selectExpr(*_PADDED)
    bare = padded.withColumns(
        {n: clean.strip_leading_zeros(F.col(n)) for n in ("order_id", "line_id")}
    )
    mapped = enrich.apply_mapping(
        bare,
        {
            "order_key": {"concat_ws": {"sep": "-", "columns": ["order_id", "line_id"]}},
            "region_id": {"lit": 500},
            "hierarchy": {"lit": "WW"},
            "fiscal_quarter": {"function": "fiscal_quarter_from_date", "args": ["ship_day"]},
        },
    )
    hooks = ProcessorRegistry()
    hooks.register("lines", lambda df: df.withColumn("spare", F.lit("")))
    hooked = hooks.apply(hooks.apply(mapped, "lines"), "another entity")
    label = F.concat(F.lit("Line "), F.col("kind"), F.lit(" month"))
    missing = F.when(F.col("kind") != "N", F.col("kind"))
    labelled = hooked.withColumns(
        {"month_label": clean.month_label(label), "kind_key": clean.normalized_key(missing)}
    )
    return labelled.withColumns(
        enrich.audit_columns(
            utc("2024-03-01 06:00:00"), "lines.csv", "loader", "landing", watermark_column="ship_day"
        )
    )


@query(
    "row_hash", "C30",
    """SELECT o_orderkey, sha256(concat_ws('|', CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END,
          CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS VARCHAR))) AS record_hash,
        sha256(concat_ws('|', CAST(o_orderkey AS VARCHAR), coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, '\\N'))) AS safe_hash
       FROM orders""",
)
def row_hash(spark, d):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    price, day = F.col("o_totalprice").cast("decimal(18,4)"), F.col("o_orderdate").cast("date")
    key = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        "o_orderkey",
        enrich.row_hash([key, status, price, day]).alias("record_hash"),
        enrich.row_hash([key, status], null_safe=True).alias("safe_hash"),
    )


@query(
    "calendar_quarter", "C28",
    """SELECT o_orderkey, concat(CAST(year(o_orderdate) AS VARCHAR), '-Q', CAST(quarter(o_orderdate) AS VARCHAR)) AS from_date,
       CASE WHEN o_custkey % 67 <> 0 THEN concat(CAST(year(o_orderdate) AS VARCHAR), '-Q', CAST(quarter(o_orderdate) AS VARCHAR)) END AS from_text
       FROM orders""",
)
def calendar_quarter(spark, d):
    day = F.col("o_orderdate").cast("date")
    text = F.when(F.col("o_custkey") % 67 != 0, day.cast("string")).otherwise("1999")
    return table(spark, d, "orders").select(
        "o_orderkey",
        enrich.calendar_quarter(day).alias("from_date"),
        enrich.calendar_quarter_text(text).alias("from_text"),
    )


_CALENDAR = """SELECT DISTINCT CAST(o_orderdate AS DATE) AS "date",
    CAST(year(CAST(o_orderdate AS DATE) + INTERVAL '2' MONTH) AS VARCHAR) AS fiscal_year,
    concat('Q', CAST(quarter(CAST(o_orderdate AS DATE) + INTERVAL '2' MONTH) AS VARCHAR)) AS fiscal_year_quarter FROM orders"""


def calendar(spark, d):
    """Fiscal calendar of the days orders were placed on; the fiscal year starts in November."""
    shifted = F.add_months(F.col("date"), 2)
    return (
        table(spark, d, "orders")
        .select(F.col("o_orderdate").cast("date").alias("date"))
        .distinct()
        .select(
            "date",
            F.year(shifted).cast("string").alias("fiscal_year"),
            F.concat(F.lit("Q"), F.quarter(shifted).cast("string")).alias("fiscal_year_quarter"),
        )
    )


CALENDAR_SQL = f"calendar AS ({_CALENDAR})"


@query(
    "calendar_lookup", "E4",
    f"""WITH {CALENDAR_SQL} SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_day,
        concat(fiscal_year_quarter, right(fiscal_year, 2)) AS fiscal_quarter
        FROM lineitem LEFT JOIN calendar ON CAST(l_shipdate AS DATE) = calendar."date" """.replace(
        "concat(fiscal_year_quarter, right(fiscal_year, 2))", "fiscal_year_quarter || right(fiscal_year, 2)"
    ),
)
def calendar_lookup(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_day")
    )
    return joins.calendar_lookup(lines, calendar(spark, d), "ship_day")


