"""Audit records and the queries over them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landflow.operators.projection import cols, quoted

# The columns of an audit record, in order.
AUDIT_COLUMNS = [
    "batchid", "batchrundate", "regionname", "datapipelinename", "pipelinerunid", "processname",
    "filename", "sourceplatform", "targetplatform", "activity", "environment", "interval", "scriptpath",
    "executionstatus", "errormessage", "executionstarttime", "executionendtime",
    "executiondurationinseconds", "datareadsize", "datawrittensize", "landingcount", "rawcount",
    "rejectcount", "previouscount", "updatedcount", "insertedcount", "totalcount", "logtimestamp",
    "jobid", "clusterid", "sourcename", "destinationname", "expected_start_time", "expected_end_time",
    "freshness", "data_refresh_mode",
]

# Statuses that mean a file needs no further validation in its batch.
HANDLED_STATUSES = ("ReadyToExecute", "Submitted", "InProgress", "Succeeded")
VALIDATION_STEP = "FileValidation"
VALIDATION_FAILED = "FileValidationFailed"

ERROR_LIMIT = 2000

_COUNTS = {
    "executiondurationinseconds", "datareadsize", "datawrittensize", "landingcount", "rawcount",
    "rejectcount", "previouscount", "updatedcount", "insertedcount", "totalcount",
}
_TIMES = {
    "executionstarttime", "executionendtime", "logtimestamp", "expected_start_time", "expected_end_time",
}


def _audit_type(name: str) -> T.DataType:
    if name in _COUNTS:
        return T.LongType()
    if name in _TIMES:
        return T.TimestampType()
    return T.DateType() if name == "batchrundate" else T.StringType()


AUDIT_SCHEMA = T.StructType([T.StructField(c, _audit_type(c)) for c in AUDIT_COLUMNS])


def as_audit(df: DataFrame, values: Mapping[str, Column] | None = None) -> DataFrame:
    """Project any frame to the audit layout; absent fields are null, errors are cut to size."""
    values = dict(values or {})

    def field(f: T.StructField) -> Column:
        c = values.get(f.name)
        if c is None:
            c = F.col(quoted(f.name)) if f.name in df.columns else F.lit(None)
        c = c.cast(f.dataType)
        return F.substring(c, 1, ERROR_LIMIT) if f.name == "errormessage" else c

    return df.select(*[field(f).alias(f.name) for f in AUDIT_SCHEMA.fields])


def audit_record(spark: SparkSession, values: Mapping[str, object]) -> DataFrame:
    """One audit row from known values."""
    row = [values.get(c) for c in AUDIT_COLUMNS]
    error = AUDIT_COLUMNS.index("errormessage")
    if row[error] is not None:
        row[error] = str(row[error])[:ERROR_LIMIT]
    return spark.createDataFrame([tuple(row)], AUDIT_SCHEMA)


def batch_id(region: Column | str, day: Column) -> Column:
    """``<REGION>Batch_yyyyMMdd``; the world-wide region writes ``WW_Batch_yyyyMMdd``."""
    name = F.lit(region) if isinstance(region, str) else region
    prefix = F.when(name == "WW", F.lit("WW_Batch_")).otherwise(F.concat(name, F.lit("Batch_")))
    return F.concat(prefix, F.date_format(day, "yyyyMMdd"))


def latest_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Latest record of each group; a map-side reduction, no sort of whole groups."""
    rest = [c for c in df.columns if c not in set(group)]
    best = df.groupBy(*cols(group)).agg(
        F.max_by(F.struct(*cols(rest)), F.struct(*cols(order))).alias("_r")
    )
    return best.select(*cols(group), *[F.col("_r")[c].alias(c) for c in rest])


def latest_failed(
    audit: DataFrame,
    processes: Sequence[str],
    group: Sequence[str] = ("processname", "filename"),
    end: str = "executionendtime",
    status: str = "executionstatus",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Failed records that are the last of their process and file."""
    chosen = audit.filter(F.col("processname").isin(*processes))
    last = latest_per_group(chosen, group, [end, *tiebreak])
    return last.filter(F.col(quoted(status)) == "Failed")


def status_transition(
    events: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    status: str = "executionstatus",
    sticky: str = VALIDATION_FAILED,
) -> DataFrame:
    """Current status per key after ``updates``, which never replace a ``sticky`` status.

    Statuses are appended, not updated: the current one is the sticky one if the
    key ever reached it, else the newest.
    """
    names = [*keys, *order, status]
    log = events.select(*cols(names), F.lit(0).alias("_rank")).unionByName(
        updates.select(*cols(names), F.lit(1).alias("_rank"))
    )
    before = (F.col("_rank") == 0) & (F.col(quoted(status)) == sticky)
    merged = log.groupBy(*cols(keys)).agg(
        F.max_by(quoted(status), F.struct(F.col("_rank"), *cols(order))).alias("_last"),
        F.bool_or(before).alias("_stuck"),
    )
    final = F.when(F.col("_stuck"), F.lit(sticky)).otherwise(F.col("_last"))
    return merged.select(*cols(keys), final.alias(status))


def ready_files(
    audit: DataFrame, day: dt.date, region: str, process: str = VALIDATION_STEP
) -> DataFrame:
    """Files waiting for the next step on a day."""
    return audit.filter(
        (F.col("batchrundate") == F.lit(day))
        & (F.col("executionstatus") == "ReadyToExecute")
        & (F.col("processname") == process)
        & (F.col("regionname") == region)
    ).select("filename", "batchid", "destinationname")


def process_metrics(audit: DataFrame) -> DataFrame:
    """Runs, failures, duration, volume and reject rate per process and day."""
    landed, rejected = F.sum("landingcount"), F.sum("rejectcount")
    return audit.groupBy("processname", "batchrundate").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("executionstatus") == "Failed").alias("failures"),
        F.sum("executiondurationinseconds").cast("bigint").alias("duration_seconds"),
        F.sum("datareadsize").cast("bigint").alias("read_bytes"),
        F.sum("datawrittensize").cast("bigint").alias("written_bytes"),
        F.when(landed > 0, (rejected.cast("decimal(28,6)") / landed).cast("decimal(18,6)"))
        .alias("reject_rate"),
    )
