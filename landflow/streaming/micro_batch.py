"""Micro-batch processing of landed files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from landflow.functions.literals import moment
from landflow.operators.projection import cols, quoted


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "csv",
    files_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """New files below ``path``, each read once."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def run_available(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Hand every micro-batch of what has landed to ``handle`` and stop.

    Delivery is at least once; ``handle`` must be repeatable, as publishing by
    batch partition and change marker is.
    """
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def replay_dedup_batch(
    rows: DataFrame, epoch: int, path: str, keys: Sequence[str], event_time: str
) -> None:
    """Write a micro-batch's rows that no earlier one has brought, by keys and event time.

    What has been written is the state, so no row is too old to be kept or to be recognised; only the
    days that the batch holds are read.  A batch that runs again replaces what it wrote.  Rows with
    null keys or times are compared null-safely.
    """
    spark = rows.sparkSession
    on = [*keys, event_time]
    day = F.coalesce(F.to_date(F.col(quoted(event_time))), F.lit("1900-01-01").cast("date"))
    batch = rows.withColumn("day", day).dropDuplicates(on)
    schema = T.StructType([*rows.schema.fields, T.StructField("epoch", T.LongType()), T.StructField("day", T.DateType())])
    try:
        before = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        before = spark.createDataFrame([], schema)
    before = before.where(F.col("epoch") != epoch).select(*cols(on), "day").alias("b")
    new = batch.alias("n")
    same = F.col("n.day") == F.col("b.day")
    for name in on:
        same = same & F.col(f"n.{quoted(name)}").eqNullSafe(F.col(f"b.{quoted(name)}"))
    fresh = new.join(before, same, "left_anti").withColumn("epoch", F.lit(epoch).cast("long"))
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch", "day").parquet(path)


def hourly_totals(
    spark: SparkSession, path: str, group: Sequence[str] = ()
) -> DataFrame:
    """The counts per hour of everything that :func:`hourly_batch` has appended."""
    parts = spark.read.parquet(path)
    return parts.groupBy("hour", *cols(group)).agg(
        F.sum("arrivals").alias("arrivals"), F.sum("rejects").alias("rejects")
    )


def hourly_batch(
    rows: DataFrame, epoch: int, path: str, event_time: str, rejected: Column, group: Sequence[str] = ()
) -> None:
    """Append a micro-batch's counts per hour; late rows just add to their hour.  A rerun replaces its own."""
    counted = hourly_metrics(rows, event_time, rejected, group)
    counted.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def stale_guard(
    df: DataFrame, event_time: str, now: dt.datetime | Column, max_age_hours: float, lower: dt.datetime
) -> DataFrame:
    """Add ``stale_reason``: missing, future, before ``lower`` or late; null for usable rows.

    Nothing is dropped: late rows go to the reject sink with their reason.
    """
    t = F.col(quoted(event_time)).cast("timestamp")
    age = F.unix_micros(moment(now)) - F.unix_micros(t)
    return df.withColumn(
        "stale_reason",
        F.when(t.isNull(), "missing")
        .when(t > moment(now), "future")
        .when(t < moment(lower), "before_lower_bound")
        .when(age > int(max_age_hours * 3_600_000_000), "late"),
    )


def incremental_filter(df: DataFrame, target: DataFrame, watermark: str) -> DataFrame:
    """Rows newer than the newest published one; everything when nothing is published."""
    newest = target.agg(F.max(quoted(watermark))).scalar()
    return df.filter(newest.isNull() | (F.col(quoted(watermark)) > newest))


def hourly_metrics(
    df: DataFrame, event_time: str, rejected: Column, group: Sequence[str] = ()
) -> DataFrame:
    """Arrivals and rejects per hour."""
    timed = df.withColumn("_t", F.col(quoted(event_time)).cast("timestamp"))
    counted = timed.groupBy(F.window("_t", "1 hour").alias("_w"), *cols(group)).agg(
        F.count(F.lit(1)).alias("arrivals"), F.count_if(rejected).alias("rejects")
    )
    return counted.select(F.col("_w.start").alias("hour"), *cols(group), "arrivals", "rejects")
