"""What the operators of this subpackage share: tables, scratch folders, small column helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below ``spark.checkpoint.dir``, which driver and executors share.

    A local session without that setting (tests) gets a temporary folder; a cluster without it
    is an error, since its executors would each write to their own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="landflow-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def settled(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, lineage cut, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, label: str) -> DataFrame:
    """``df`` written as a table in buckets of ``key``: joins on ``key`` move the other side only.

    There are as many buckets as shuffle partitions, and each is one file.
    """
    spark = df.sparkSession
    parts, path = shuffle_partitions(spark), scratch_path(spark, label)
    name = "llm_" + path.rsplit("/", 1)[-1].replace("-", "_")
    rows = df.repartition(parts, key).write.bucketBy(parts, key)
    rows.option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
