"""Regional curated-to-published load with its report.

The regions differ only in constants and filters, so they are rows of a table
and one pass serves any number of them; the segment is part of the key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landflow.functions import clean, enrich
from landflow.operators.filters import business_exclusions
from landflow.operators.history import HistorySpec, merge_history, one_per_key
from landflow.operators.joins import calendar_lookup
from landflow.operators.projection import cols, quoted
from landflow.operators.report import report_rollup


@dataclass(frozen=True)
class Region:
    """Constants of one region; ``nonneg`` keeps rows whose measure is at least zero."""

    name: str
    segment: str
    region_id: int
    nonneg: bool


# Regions, the segment texts of the source, ids and filters.
REGIONS = (
    Region("AMS", "Americas", 503, True),
    Region("APJ", "Asia Pacific", 502, True),
    Region("EMEA", "EMEA", 500, False),
)

# The business key of an order line; dates default to 1900-01-01.
ORDER_KEYS = (
    "order_type", "order_create_date", "sales_order_identifier", "sales_order_line_item_identifier",
    "source_type", "shipment_date", "delivery_identifier", "segment",
)
ORDER_DATE_KEYS = ("order_create_date", "shipment_date")


@dataclass(frozen=True)
class RegionalSpec:
    """Column names of the curated table."""

    keys: tuple[str, ...] = ORDER_KEYS
    date_keys: tuple[str, ...] = ORDER_DATE_KEYS
    segment: str = "segment"
    order_id: str = "sales_order_identifier"
    line_id: str = "sales_order_line_item_identifier"
    kind: str = "cp_backlog_sni_revenue"
    quantity: str = "sum_of_sales_order_base_quantity"
    priority_measure: str = "eg_net_revenue"
    filter_measure: str = "secured_position_net_usd"
    marker: str = "process_timestamp"
    batch_date: str = "batch_run_dt"

    @property
    def history(self) -> HistorySpec:
        return HistorySpec(
            keys=self.keys, change_column=self.marker, date_keys=self.date_keys, version=None
        )


def deduplicate(curated: DataFrame, spec: RegionalSpec) -> DataFrame:
    """One row per normalised key by priority; ids lose their leading zeros first."""
    order = [
        enrich.type_priority(F.col(quoted(spec.kind))),
        enrich.quantity_priority(
            F.col(quoted(spec.quantity)), F.col(quoted(spec.priority_measure))
        ),
    ]
    ids = {
        name: clean.strip_leading_zeros(F.col(quoted(name))) for name in (spec.order_id, spec.line_id)
    }
    rest = [c for c in curated.columns if c not in spec.keys] + list(spec.keys)
    return one_per_key(curated.withColumns(ids), spec.history, order, rest)


def in_scope(curated: DataFrame, spec: RegionalSpec, regions: Sequence[Region]) -> DataFrame:
    """Rows of keys that ``admitted`` can keep, so that no others are shuffled.

    Only what all rows of a normalised key share decides here: a missing id counts as blank, and columns
    that are not in the key are left to ``admitted``.
    """
    texts = {n: clean.normalized_key(F.col(quoted(n))) for n in spec.keys if n not in spec.date_keys}
    marked = curated.withColumns({f"_{n}": c for n, c in texts.items() if n in (spec.segment, spec.order_id, spec.line_id)})
    if spec.segment in texts:
        marked = marked.filter(F.col(quoted(f"_{spec.segment}")).isin([r.segment for r in regions]))
    if spec.order_id in texts and spec.line_id in texts:
        marked = business_exclusions(marked, f"_{spec.order_id}", f"_{spec.line_id}")
    return marked.select(*cols(curated.columns))


def admitted(rows: DataFrame, spec: RegionalSpec, regions: Sequence[Region]) -> DataFrame:
    """Rows of the given regions that pass their filters, with the region's constants."""
    segment = F.trim(F.col(quoted(spec.segment)))
    stamped = rows.withColumns(
        {
            "region": enrich.lookup(segment, {r.segment: r.name for r in regions}),
            "region_id": enrich.lookup(segment, {r.segment: r.region_id for r in regions}),
        }
    ).filter(F.col("region").isNotNull())
    strict = [r.name for r in regions if r.nonneg]
    if strict:
        measure = F.col(quoted(spec.filter_measure))
        stamped = stamped.filter(~F.col("region").isin(*strict) | (measure >= 0))
    return business_exclusions(stamped, spec.order_id, spec.line_id)


def regional_batch(
    curated: DataFrame,
    calendar: DataFrame,
    spec: RegionalSpec | None = None,
    regions: Sequence[Region] = REGIONS,
) -> DataFrame:
    """Rows a batch brings to the published table, before comparison with it."""
    spec = spec or RegionalSpec()
    rows = admitted(deduplicate(in_scope(curated, spec, regions), spec), spec, regions)
    with_quarter = calendar_lookup(rows, calendar, spec.batch_date)
    key = enrich.concat_key(F.col(quoted(spec.order_id)), F.col(quoted(spec.line_id)))
    return with_quarter.withColumn("sap_order_key", key)


def regional_merge(
    published: DataFrame, batch: DataFrame, run_ts: dt.datetime, spec: RegionalSpec | None = None
) -> DataFrame:
    """Published rows after the batch: current rows plus the versions it closed."""
    spec = spec or RegionalSpec()
    return merge_history(published, batch, spec.history, run_ts)


def regional_report(published: DataFrame) -> DataFrame:
    """Measures per region and order key over current rows."""
    return report_rollup(
        published,
        ["region", "sap_order_key"],
        {"secured_position": "secured_position_net_usd", "eg_revenue": "eg_net_revenue"},
    )
