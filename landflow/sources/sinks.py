"""Writers.  Each call is one Spark write job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landflow.operators.audit import as_audit
from landflow.sources import commits

#: Tables hold a digest in each row, as hexadecimal digits: twice the bytes that are in it, unless coded by frequency.
CODEC = "zstd"


def stage_overwrite(df: DataFrame, path: str) -> DataFrame:
    """Replace the curated table; returns the table as written.

    Each load is a folder of its own that counts once it is complete, so a job that dies leaves the table
    as it was.  The load before stays, for readers that have begun; older ones and remains go.
    """
    spark = df.sparkSession
    before = commits.committed(spark, path)
    number = int(before[-1].split("-", 1)[0]) + 1 if before else 1
    name = commits.unique(f"{number:012d}")
    df.write.option("compression", CODEC).parquet(f"{path}/{name}")
    for old in commits.folders(spark, path):
        if old not in (name, *before[-1:]):
            commits.remove(spark, f"{path}/{old}")
    return spark.read.schema(df.schema).parquet(f"{path}/{name}")


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete load of a curated table."""
    return spark.read.parquet(f"{path}/{commits.committed(spark, path)[-1]}")


def write_piped(
    df: DataFrame, path: str, source_name: str, created_by: str, run_date: dt.date
) -> None:
    """Clean output as ``|``-separated text with header and load stamps.

    Overwriting removes what an earlier run of the entity left at ``path``.
    """
    stamped = df.withColumns(
        {
            "SOURCE_NAME": F.lit(source_name),
            "CREATED_BY": F.lit(created_by),
            "BATCH_RUN_DT": F.lit(run_date).cast("string"),
        }
    )
    stamped.write.mode("overwrite").option("sep", "|").option("header", True).option(
        "encoding", "UTF-8"
    ).csv(path)


def _replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Overwrite only the partitions present in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_rejects(rejects: DataFrame, path: str, entity: str, run_date: dt.date) -> None:
    """Rejected rows (or a whole rejected file) of one entity and day; a rerun replaces them."""
    stamped = rejects.withColumns({"entity": F.lit(entity), "dt": F.lit(run_date)})
    _replace_partitions(stamped, path, ["entity", "dt"])


def archive_layout(df: DataFrame, path: str, logical_name: str, run_date: dt.date) -> None:
    """Processed data below ``dt=<day>/logical_name=<name>``."""
    stamped = df.withColumns({"dt": F.lit(run_date), "logical_name": F.lit(logical_name)})
    _replace_partitions(stamped, path, ["dt", "logical_name"])


def write_snapshot(df: DataFrame, path: str, date_column: str = "snapshot_date") -> None:
    """Add a snapshot as its own partition; loading the same day again replaces that day."""
    _replace_partitions(df, path, [date_column])


def append_audit(records: DataFrame, path: str) -> None:
    as_audit(records).write.mode("append").parquet(path)
