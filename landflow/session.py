"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Settings the operators rely on.  Timestamps are compared in UTC, AQE sizes
#: the shuffles and splits skewed join partitions.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: Bytes of files, and shuffled bytes, that a task is given.  The latter are compressed: narrow rows are ten times as
#: large where they are sorted or counted.
FILE_SHARE, SHARE = "16m", "8m"
#: Shuffles begin with so many times the session's partitions, and with one at least for so many bytes of the tables: AQE
#: puts small ones together again but splits none, so a task's share is bounded by bytes only if there are enough of them.
PARTITIONS_X, TABLE_SHARE = 4, 1 << 21

#: Worth setting where the session is built.  Recording the call site of every Column is a
#: debugging aid that slows down building plans over hundreds of columns.
ADVISED_STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`REQUIRED_CONF` to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, tables: str | None = None) -> SparkSession:
    """Many small shares instead of few large ones, for the engine's joins, sorts and windows.

    ``tables`` is the folder of the input, whose files are listed, not read.
    """
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", SHARE)
    spark.conf.set("spark.sql.files.maxPartitionBytes", FILE_SHARE)
    partitions = PARTITIONS_X * int(spark.conf.get("spark.sql.shuffle.partitions"))
    if tables:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(tables)
        held = files.agg(F.sum("length")).first()[0] or 0
        partitions = max(partitions, -(-held // TABLE_SHARE))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder named by ``spark.checkpoint.dir``.

    Where the session names none, a local session (tests) gets a temporary folder; on a cluster that
    is an error, since executors would each write to their own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="landflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/landflow/{label}-{uuid.uuid4().hex}"
