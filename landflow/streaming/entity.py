"""An entity's files as a stream: each new one is admitted, checked, curated and published once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from landflow.config import EntityConfig
from landflow.operators.admission import file_name
from landflow.plans.run import run_entity
from landflow.sources import readers
from landflow.streaming.micro_batch import run_available


def landed_lines(spark: SparkSession, landing: str, config: EntityConfig, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of new data files below ``landing`` with what admission asks of a file; manifests are left out."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.load(landing).select(
        *readers.line_columns(), F.col("_metadata.file_size").alias("length"), F.col("_metadata.file_modification_time").alias("modificationTime")
    )
    return lines.where(~file_name(F.col("path")).startswith(config.manifest_prefix))


def stream_entity(
    spark: SparkSession,
    landing: str,
    config: EntityConfig,
    root: str,
    now: dt.datetime | Callable[[], dt.datetime],
    name: str = "entity",
    region: str = "",
    files_per_trigger: int | None = None,
    parts: int = 64,
) -> StreamingQuery:
    """Run :func:`run_entity` on what has landed since the last time, a micro-batch after the other.

    A micro-batch's text is scanned once, and its files are listed from there: a file without a line is
    never part of one.  The checkpoint below ``root`` remembers which files have been taken.  A batch that
    runs again publishes nothing twice, since its rows are unchanged then; its audit records repeat.
    """

    def handle(rows: DataFrame, epoch: int) -> None:
        numbered = readers.number_lines(rows, ["length", "modificationTime"])
        listing = numbered.groupBy("path").agg(F.first("length").alias("length"), F.first("modificationTime").alias("modificationTime"))
        run_ts = now() if callable(now) else now + dt.timedelta(seconds=epoch)
        run_entity(
            spark, landing, config, root, run_ts, f"epoch_{epoch}", name, region, parts,
            lines=numbered.drop("length", "modificationTime"), listing=listing,
        )

    return run_available(landed_lines(spark, landing, config, files_per_trigger), handle, f"{root}/checkpoint/{name}")
