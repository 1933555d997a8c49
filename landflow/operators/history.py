"""Versioned history (SCD2) without row updates.

A published table is ``current`` (one row per key) plus ``history`` (closed
versions).  ``merge_history`` joins ``current`` with one batch once and returns
every row that is current afterwards together with the versions the batch
closed.  Its cost does not depend on the size of the history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landflow.functions.literals import moment
from landflow.operators.duplicates import priority_dedup
from landflow.operators.joins import key_columns, with_keys
from landflow.operators.projection import cols, quoted
from landflow.session import scratch_path


@dataclass(frozen=True)
class HistorySpec:
    """Column roles of a published history table."""

    keys: tuple[str, ...]
    change_column: str
    date_keys: tuple[str, ...] = ()
    #: rows not newer than the current one by this column change nothing
    order_column: str | None = None
    start: str = "start_date"
    end: str = "end_date"
    flag: str = "is_current_fg"
    flag_on: object = "Y"
    flag_off: object = "N"
    version: str | None = "version"
    updated: str | None = "last_update_dt"
    #: a version starts at the value of this column; at the run's time if none is named
    start_from: str | None = None

    def generated(self) -> dict[str, str]:
        """Columns this module fills, with their types."""
        flag_type = "boolean" if isinstance(self.flag_on, bool) else "string"
        types = {self.start: "timestamp", self.end: "timestamp", self.flag: flag_type}
        if self.version:
            types[self.version] = "int"
        if self.updated:
            types[self.updated] = "timestamp"
        return types


def versioned_spec(keys: Sequence[str], change_column: str, **more) -> HistorySpec:
    """The layout with ``version, is_active, effective_ts, end_ts``."""
    return HistorySpec(
        keys=tuple(keys), change_column=change_column, start="effective_ts", end="end_ts",
        flag="is_active", flag_on=True, flag_off=False, updated=None, **more,
    )


def first_load(staging: DataFrame, spec: HistorySpec, run_ts: dt.datetime) -> DataFrame:
    """``current`` after the first batch: everything is version 1."""
    return staging.drop(*key_columns(spec.keys)).withColumns(_fresh(spec, run_ts, F.lit(1)))


def _fresh(spec: HistorySpec, run_ts: dt.datetime, version: Column) -> dict[str, Column]:
    values: dict[str, Column] = {
        spec.start: moment(run_ts),
        spec.end: F.lit(None),
        spec.flag: F.lit(spec.flag_on),
    }
    if spec.version:
        values[spec.version] = version
    if spec.updated:
        values[spec.updated] = moment(run_ts)
    types = spec.generated()
    return {name: value.cast(types[name]) for name, value in values.items()}


def one_per_key(
    staging: DataFrame, spec: HistorySpec, order: Sequence[Column] = (), tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """First row per *normalised* key by ``order``; the key texts stay as columns.

    Rows whose keys differ only in blanks or in null against blank count as one
    key, as they do in the merge, and the merge reuses this partitioning.
    """
    rest = staging.columns if tiebreak is None else tiebreak
    keyed = with_keys(staging, spec.keys, spec.date_keys)
    return priority_dedup(keyed, list(key_columns(spec.keys)), list(order), tiebreak=list(rest))


def merge_history(
    current: DataFrame, staging: DataFrame, spec: HistorySpec, run_ts: dt.datetime
) -> DataFrame:
    """Current rows after the batch, and the versions it closed, in one DataFrame.

    ``staging`` holds at most one row per key (see ``one_per_key``).  Rows with
    ``spec.flag`` on replace ``current``; the others are appended to the history.
    Merging the same batch again closes nothing and changes nothing.
    """
    keys = list(key_columns(spec.keys))
    names = [c for c in current.columns if c not in keys]
    offered = [c for c in staging.columns if c not in keys]
    old = with_keys(current, spec.keys, spec.date_keys).select(
        *keys, F.struct(*cols(names)).alias("_old")
    )
    new = with_keys(staging, spec.keys, spec.date_keys).select(
        *keys, F.struct(*cols(offered)).alias("_new")
    )
    joined = old.join(new, keys, "full_outer")

    o, n = F.col("_old"), F.col("_new")
    same = o[spec.change_column].eqNullSafe(n[spec.change_column])
    changed = o.isNotNull() & n.isNotNull() & ~same
    if spec.order_column:
        stale = F.coalesce(n[spec.order_column] <= o[spec.order_column], F.lit(False))
        changed = changed & ~stale
    inserted = changed | o.isNull()

    last_version = F.coalesce(o[spec.version], F.lit(0)) if spec.version else F.lit(0)
    fresh = _fresh(spec, run_ts, last_version + 1)
    judged = joined.withColumns(
        {"_changed": changed, "_inserted": inserted, **{f"_fresh_{c}": v for c, v in fresh.items()}}
    )
    # wide rows are written as one SQL text: a Column per field costs a call to the JVM each
    types, given = dict(current.dtypes), dict(staging.dtypes)

    def new_field(name: str) -> str:
        if name in fresh:
            return quoted(f"_fresh_{name}")
        if name not in given:
            return f"CAST(NULL AS {types[name]})"
        value = f"_new.{quoted(name)}"
        return value if given[name] == types[name] else f"CAST({value} AS {types[name]})"

    fields = ", ".join(f"{new_field(c)} AS {quoted(c)}" for c in names)
    live = F.when(F.col("_inserted"), F.expr(f"struct({fields})")).otherwise(o)
    closing = {spec.end: moment(run_ts), spec.flag: F.lit(spec.flag_off)}
    if spec.updated:
        closing[spec.updated] = moment(run_ts)
    ended = o
    for name, value in closing.items():
        ended = ended.withField(quoted(name), value.cast(types[name]))
    closed = F.when(F.col("_changed"), ended)
    rows = judged.select(F.explode(F.array_compact(F.array(live, closed))).alias("_row"))
    return rows.select("_row.*")


def versions_of_batch(
    current: DataFrame, staging: DataFrame, spec: HistorySpec, run_ts: dt.datetime, spread: Sequence[str] = ()
) -> DataFrame:
    """Every row that ``current`` and a batch with any number of rows per key lead to.

    A key's rows line up behind its current row: by ``spec.order_column`` and change marker, and
    each becomes a version if its marker is not that of the row before it.  A version ends where the
    next one starts.  Column ``_kind`` of the result tells what becomes of a row:

    * ``current``: in force afterwards; ``closed``: ended by this batch;
    * ``unchanged``: a repeat of the row before it, or of the current row whatever its time;
    * ``stale``: not newer than the current row, and unlike it;
    * ``conflict``: one of several unlike rows of a key where no order column says which comes first.

    No row of the batch is left out.  ``_brought`` tells the batch's rows from the current ones.
    Both sides have the same columns, besides those that :meth:`HistorySpec.generated` names.

    Rows are shuffled and sorted once: all windows share one order.  ``spread`` may name columns of both sides,
    functions of the normalised key, by which the rows are shuffled instead of the key, and stay.
    """
    keys = list(key_columns(spec.keys))
    types = spec.generated()
    names = [c for c in current.columns if c not in keys]
    old = current.withColumn("_brought", F.lit(False))
    new = staging.withColumns(
        {**{name: F.lit(None).cast(kind) for name, kind in types.items()}, "_brought": F.lit(True)}
    )
    marker = F.col(quoted(spec.change_column))
    if spread:
        rows = _spread_out(old.drop(*keys).unionByName(new.drop(*keys)), spec.change_column, spread)
        rows = with_keys(rows, spec.keys, spec.date_keys)  # key texts are not shuffled
    else:
        rows = with_keys(old, spec.keys, spec.date_keys).unionByName(with_keys(new, spec.keys, spec.date_keys))
    order = [F.col(quoted(spec.order_column))] if spec.order_column else []
    line = Window.partitionBy(*cols(spread), *keys).orderBy("_brought", *[c.asc_nulls_first() for c in [*order, marker]])
    family = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if order:
        held = F.max(F.when(~F.col("_brought"), order[0])).over(family)
        late = F.col("_brought") & F.coalesce(order[0] <= held, F.lit(False))
        held_marker = F.max(F.when(~F.col("_brought"), F.struct(marker))).over(family)
        refused = F.when(late & F.struct(marker).eqNullSafe(held_marker), "unchanged").when(late, "stale")
    else:
        brought = F.when(F.col("_brought"), F.coalesce(marker.cast("string"), F.lit("")))
        unlike = (F.min(brought).over(family) != F.max(brought).over(family)) | (
            F.max(F.when(F.col("_brought"), marker.isNull().cast("int"))).over(family)
            != F.min(F.when(F.col("_brought"), marker.isNull().cast("int"))).over(family)
        )
        refused = F.when(F.col("_brought") & F.coalesce(unlike, F.lit(False)), "conflict")
    rows = rows.withColumn("_refused", refused)
    # refused rows are nobody's predecessor
    earlier = line.rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.when(F.col("_refused").isNull(), F.struct(marker)), ignorenulls=True).over(earlier)
    rows = rows.withColumn("_same", before.isNotNull() & before.eqNullSafe(F.struct(marker)))
    accepted = F.col("_refused").isNull() & ~F.col("_same")
    # among the versions of a key: number, and start of the next one
    start = moment(run_ts)
    if spec.start_from:
        start = F.coalesce(F.col(quoted(spec.start_from)).cast("timestamp"), start)
    begins = F.when(F.col("_brought"), start).otherwise(F.col(quoted(spec.start)))
    rows = rows.withColumns({"_begins": begins, "_next": F.when(accepted, F.struct(begins.alias("at")))})
    rows = rows.withColumns(
        {
            "_next": F.expr("lead(_next) IGNORE NULLS").over(line),
            "_at": F.sum(accepted.cast("int")).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int"),
            **({"_base": F.max(F.when(~F.col("_brought"), F.col(quoted(spec.version)))).over(family)} if spec.version else {}),
        }
    )
    values = {
        "_kind": F.when(F.col("_refused").isNotNull(), F.col("_refused"))
        .when(F.col("_same"), "unchanged")
        .when(F.col("_next").isNull(), "current")
        .otherwise("closed"),
        "_ends": F.col("_next")["at"],
    }
    if spec.version:
        values["_number"] = F.coalesce(F.col("_base") - 1, F.lit(0)) + F.col("_at")
    rows = rows.withColumns(values)
    is_version = F.col("_kind").isin("current", "closed")
    on = F.when(F.col("_kind") == "current", F.lit(spec.flag_on)).otherwise(F.lit(spec.flag_off))
    filled = {
        spec.start: F.when(is_version, F.col("_begins")),
        spec.end: F.when(is_version, F.col("_ends")),
        spec.flag: F.when(is_version, on),
    }
    if spec.version:
        filled[spec.version] = F.when(is_version, F.col("_number"))
    if spec.updated:
        touched = F.col("_brought") | (F.col("_kind") == "closed")
        filled[spec.updated] = F.when(is_version & touched, moment(run_ts)).otherwise(F.col(quoted(spec.updated)))
    rows = rows.withColumns({name: value.cast(types[name]) for name, value in filled.items()})
    return rows.select(*cols(names), "_kind", "_brought")


def _spread_out(rows: DataFrame, marker: str, by: Sequence[str]) -> DataFrame:
    """The rows shuffled by these columns; markers of 64 hexadecimal digits travel as the 32 bytes they stand for."""
    if dict(rows.dtypes)[marker] != "string":
        return rows.repartition(*cols(by))
    text, names = F.col(quoted(marker)), rows.columns
    packed = F.when(text.rlike("^[0-9a-f]{64}$"), F.unhex(text))
    rows = rows.withColumns({"_packed": packed, marker: F.when(packed.isNull(), text)}).repartition(*cols(by))
    return rows.withColumn(marker, F.coalesce(F.lower(F.hex("_packed")), text)).select(*cols(names))


def versions_alone(staging: DataFrame, spec: HistorySpec, run_ts: dt.datetime) -> DataFrame:
    """What :func:`versions_of_batch` makes of rows whose key no other row has, current or new: all are in force."""
    rows = first_load(staging, spec, run_ts)
    if spec.start_from:
        start = F.coalesce(F.col(quoted(spec.start_from)).cast("timestamp"), moment(run_ts))
        rows = rows.withColumn(spec.start, start.cast(spec.generated()[spec.start]))
    return rows.withColumns({"_kind": F.lit("current"), "_brought": F.lit(True)})


def split_merged(merged: DataFrame, spec: HistorySpec) -> tuple[DataFrame, DataFrame]:
    """``(current, newly closed)``."""
    on = F.col(quoted(spec.flag)) == F.lit(spec.flag_on)
    return merged.filter(on), merged.filter(~on)


# ---------------------------------------------------------------- versions


def version_intervals(
    df: DataFrame,
    keys: Sequence[str],
    effective: str,
    tiebreak: Sequence[str] = (),
    bucket: Column | None = None,
    version: str = "version",
    end: str = "end_ts",
) -> DataFrame:
    """Number a key's versions 1, 2, 3 ... and end each where the next one starts.

    Rows are sorted by key and time over all tasks, so a key with very many versions lies in many ranges.
    Each range numbers its own rows, and only its counts and first times are carried along the key from
    one range to the next.  The sorted rows are written to the shared folder, which fixes the ranges.

    ``bucket``, a non-decreasing function of the effective time (a day, a month), may name the ranges of a
    key instead; then nothing is sorted over all tasks or written.
    """
    order = [*cols([effective]), *cols(tiebreak)]
    time = F.col(quoted(effective))
    if bucket is None:
        ranges = [*cols(keys), *order]
        spread = df.repartitionByRange(*ranges).withColumn("_bucket", F.spark_partition_id())
        path = scratch_path(df.sparkSession, "ranges")
        spread.write.parquet(path)
        bucketed = df.sparkSession.read.schema(spread.schema).parquet(path)
        return _numbered_by_bucket(df, bucketed, keys, order, time, version, end)
    return _numbered_by_bucket(df, df.withColumn("_bucket", bucket), keys, order, time, version, end)


def _numbered_by_bucket(
    df: DataFrame, bucketed: DataFrame, keys: Sequence[str], order: list[Column], time: Column, version: str, end: str
) -> DataFrame:
    """Rows numbered within key and bucket, plus what the key's earlier buckets carry over."""
    group = [*cols(keys), F.col("_bucket")]
    summary = bucketed.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"), F.min(time).alias("_first")
    )
    along = Window.partitionBy(*cols(keys)).orderBy("_bucket")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    offsets = summary.select(
        *group,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.lead("_first").over(along).alias("_next"),
    )
    inner = Window.partitionBy(*group).orderBy(*order)
    numbered = bucketed.withColumns(
        {"_rank": F.row_number().over(inner), "_lead": F.lead(time).over(inner)}
    )
    # key columns compare null-safely, as they do in a window
    left, right = numbered.alias("l"), offsets.alias("r")
    same = [
        F.col(f"l.{quoted(k)}").eqNullSafe(F.col(f"r.{quoted(k)}")) for k in [*keys, "_bucket"]
    ]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    return left.join(right, condition).select(
        *[F.col(f"l.{quoted(c)}") for c in df.columns],
        (F.col("_offset") + F.col("_rank")).cast("int").alias(version),
        F.coalesce(F.col("_lead"), F.col("_next")).alias(end),
    )


def version_number(df, keys, effective, tiebreak=(), bucket=None, version="version") -> DataFrame:
    return version_intervals(df, keys, effective, tiebreak, bucket, version, "_end").drop("_end")


def interval_end(df, keys, effective, tiebreak=(), bucket=None, end="end_ts") -> DataFrame:
    return version_intervals(df, keys, effective, tiebreak, bucket, "_version", end).drop("_version")


def next_version(
    staging: DataFrame, target: DataFrame, keys: Sequence[str], version: str = "version"
) -> DataFrame:
    """Batch rows with the version number their key gets next."""
    last = target.groupBy(*cols(keys)).agg(F.max(quoted(version)).alias("_last"))
    joined = staging.join(last, list(keys), "left")
    return joined.select(
        *cols(staging.columns), (F.coalesce(F.col("_last"), F.lit(0)) + 1).cast("int").alias(version)
    )


# ---------------------------------------------------------------- reading history


def as_of_view(
    table: DataFrame, at: dt.datetime, start: str = "effective_ts", end: str = "end_ts"
) -> DataFrame:
    """Versions in force at a moment; intervals are half open."""
    s, e, t = F.col(quoted(start)), F.col(quoted(end)), moment(at)
    return table.filter((s <= t) & (e.isNull() | (t < e)))


def change_history(
    table: DataFrame, keys: Sequence[str], start: str = "effective_ts", end: str = "end_ts"
) -> DataFrame:
    """Versions of the keys that changed at least once, with how long each was in force."""
    changed = table.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("version_count"))
    span = F.unix_timestamp(F.col(quoted(end))) - F.unix_timestamp(F.col(quoted(start)))
    return (
        table.join(changed.filter("version_count > 1"), list(keys))
        .withColumn("seconds_in_force", span)
    )


def rollback_to(
    table: DataFrame, at: dt.datetime | Column, spec: HistorySpec
) -> DataFrame:
    """The table as it was just before ``at``: later versions vanish, what they closed reopens."""
    t = moment(at)
    start, end = F.col(quoted(spec.start)), F.col(quoted(spec.end))
    reopened = end.isNull() | (end >= t)
    kept = table.filter(start < t)
    values = {
        spec.end: F.when(~reopened, end),
        spec.flag: F.when(reopened, F.lit(spec.flag_on)).otherwise(F.lit(spec.flag_off)),
    }
    return kept.withColumns(values).select(*cols(table.columns))


def rollback_before_file(
    table: DataFrame, source_file: str, spec: HistorySpec, file_column: str = "source_file"
) -> DataFrame:
    """Undo a file and everything loaded after it.

    A file that brought no version (unknown, or an unchanged extract) changes nothing.
    """
    loaded = table.filter(F.col(quoted(file_column)) == source_file)
    first = F.coalesce(loaded.agg(F.min(quoted(spec.start))).scalar(), F.lit("9999-12-31").cast("timestamp"))
    return rollback_to(table, first, spec)


# ---------------------------------------------------------------- insert columns


def column_defaults(
    staging: DataFrame,
    primary_keys: Sequence[str],
    hash_columns: Sequence[str],
    defaults: Mapping[str, Column],
    surrogate: str | None = None,
) -> DataFrame:
    """Insert projection: keys, hashed columns and audit columns, once each, in that order."""
    order = dict.fromkeys([*primary_keys, *hash_columns, *defaults])
    order.pop(surrogate, None)
    return staging.select(
        *[
            (defaults[name] if name in defaults else F.col(quoted(name))).alias(name)
            for name in order
        ]
    )


def scd2_defaults(
    run_ts: dt.datetime, created_by: str = "landflow", source_nm: str = "landflow"
) -> dict[str, Column]:
    """Audit columns of a newly inserted version; their names are fixed values."""
    stamp = moment(run_ts)
    return {
        "record_hash": F.col("record_hash"),
        "start_date": stamp,
        "end_date": F.lit(None).cast("timestamp"),
        "is_current_fg": F.lit("Y"),
        "batch_run_dt": stamp,
        "created_by": F.lit(created_by),
        "create_dt": stamp,
        "last_update_dt": stamp,
        "source_nm": F.lit(source_nm),
        "source_file_name": F.col("source_file_name"),
    }


def surrogate_id(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    start: int | Column = 1,
    groups: int | None = None,
) -> DataFrame:
    """Dense ids ``start, start+1, ...`` over rows with unique ``keys``, in the order of the keys' digest.

    Rows are spread by ranges of the digest and numbered within their range; only the ranges' sizes are
    summed up in order.  The number of ranges (64 for each shuffle partition) does not change the ids,
    and they depend on the data alone, so a recomputed partition gets the same.
    """
    ranges = groups or 64 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols(keys)]))
    leading = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    spread = df.withColumns({"_digest": digest, "_group": F.shiftright(leading * F.lit(ranges), 32)})
    sizes = spread.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_group", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_offset"))
    inner = Window.partitionBy("_group").orderBy("_digest", *cols(keys))
    numbered = spread.withColumn("_rank", F.row_number().over(inner)).join(offsets, "_group")
    first = F.lit(start) if isinstance(start, int) else start
    value = (first + F.col("_offset") + F.col("_rank") - 1).cast("bigint")
    return numbered.select(value.alias(name), *cols(df.columns))


def surrogate_id_after(
    df: DataFrame, table: DataFrame, keys: Sequence[str], name: str, groups: int | None = None
) -> DataFrame:
    """Ids for new rows that go on after the largest one stored in ``table``, from 1 where there is none."""
    last = F.coalesce(table.agg(F.max(quoted(name))).scalar(), F.lit(0).cast("bigint"))
    return surrogate_id(df, keys, name, last + 1, groups)
