"""Replayed rows of a stream, told by keyed state.

State is kept by Spark's state store (RocksDB), with a time to live, and is part of the query's checkpoint:
nothing that was written is read again, and a restarted query goes on where it stopped.  A row older than
the time to live can't be told from a replay any more; it is handed out as late, for a reject sink.

Spark asks the state store once for each group, which costs far more than a row.  So a group is one of
``DEALT`` shares of an hour of event time, not one key: its state is a list of the 128-bit fingerprints of
keys and event times that it has seen, one entry a micro-batch, and a micro-batch reads the hours it holds.
"""

from __future__ import annotations

import datetime as dt
import struct
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from landflow.functions.literals import moment
from landflow.operators.duplicates import fingerprint
from landflow.operators.projection import cols, quoted

OUTCOME = "_outcome"
FRESH, REPLAYED, LATE = "fresh", "replayed", "late"
_LATE, _HOUR, _DEAL, _PRINT = "_late", "_hour", "_deal", ("_f1", "_f2")
#: Shares of an hour of event time, so that rows of one hour are spread over the tasks.
DEALT = 32
_PAIRS = struct.Struct("<qq")

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstOnly(StatefulProcessor):
    """The first row of each fingerprint is fresh, the others are replays, now and in later micro-batches."""

    def __init__(self, names: Sequence[str], keep_ms: int):
        self.names, self.keep_ms = list(names), keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getListState("seen", "prints binary", ttlDurationMs=self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known, fresh = None, []
        for row in rows:
            if row[_LATE]:
                outcome = LATE
            else:
                if known is None:
                    known = {p for (prints,) in self.seen.get() for p in _PAIRS.iter_unpack(prints)}
                one = (row[_PRINT[0]], row[_PRINT[1]])
                outcome = REPLAYED if one in known else FRESH
                if outcome == FRESH:
                    known.add(one)
                    fresh.append(_PAIRS.pack(*one))
            yield Row(**{n: row[n] for n in self.names}, **{OUTCOME: outcome})
        if fresh:
            self.seen.appendValue((b"".join(fresh),))

    def close(self) -> None:
        pass


def use_keyed_state(spark: SparkSession) -> None:
    """Keyed state of any form needs the RocksDB state store.

    A time to live asks for a further micro-batch after each one, so a query over what has landed would
    never end: micro-batches without rows are turned off, and state expires as rows arrive.
    """
    spark.conf.set(_STORE, _ROCKSDB)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")


def mark_replays(
    stream: DataFrame, keys: Sequence[str], event_time: str, now: dt.datetime, keep: dt.timedelta
) -> DataFrame:
    """Every row of the stream with its ``_outcome``: ``fresh``, ``replayed`` or ``late``.

    Rows are one and the same if keys and event time are, null for null.  ``keep`` is how long a row is
    remembered, and the age, at ``now``, from which a row is late.  Rows are dealt out by the fingerprint of
    key and event time, so a key or an hour with very many rows is spread over the tasks.
    """
    use_keyed_state(stream.sparkSession)
    names = stream.columns
    time = F.col(quoted(event_time)).cast("timestamp")
    marked = stream.select(
        *cols(names),
        F.coalesce(time < moment(now - keep), F.lit(False)).alias(_LATE),
        F.floor(F.unix_seconds(time) / 3600).alias(_HOUR),
        *fingerprint(list(dict.fromkeys([*keys, event_time]))),
    ).withColumn(_DEAL, F.pmod(_PRINT[0], F.lit(DEALT)))
    schema = T.StructType([*stream.schema.fields, T.StructField(OUTCOME, T.StringType())])
    processor = FirstOnly(names, int(keep.total_seconds() * 1000))
    return marked.groupBy(_HOUR, _DEAL).transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode="ProcessingTime"
    )


def write_outcomes(rows: DataFrame, epoch: int, path: str) -> None:
    """A micro-batch's rows by outcome; a batch that runs again replaces what it wrote."""
    rows.write.mode("overwrite").partitionBy(OUTCOME).parquet(f"{path}/epoch={epoch}")


def read_outcome(spark: SparkSession, path: str, outcome: str, schema: T.StructType) -> DataFrame:
    """The rows of one outcome that have been written; ``schema`` is that of the stream."""
    stored = T.StructType([*schema.fields, T.StructField(OUTCOME, T.StringType())])
    rows = spark.read.schema(stored).parquet(path).where(F.col(OUTCOME) == outcome)
    return rows.select(*cols(schema.names))
