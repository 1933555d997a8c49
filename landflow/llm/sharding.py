"""Contiguous shards of equal bytes, by global prefix sums.  Built-in functions only.

Rows are put into one global order (hash of the text, then id, so equal texts are neighbours) by a
range partitioning, which spreads even one text's copies over partitions.  Each partition sums its
sizes; the partitions' totals give each one its offset; offset plus the sum within the partition is
a row's place in the whole.  Cutting that line at equal targets gives the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landflow.llm.common import settled, shuffle_partitions, text_of

#: What a document needs in a shard besides its bytes.
ROW_BYTES = 8
ORDER = ["h", "crc", "size", "id"]
GROUP = ["h", "crc", "size"]


def ordered_rows(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """Every row with its size, its partition in the global order, and its sums up to and including itself."""
    body = text_of(text)
    parts = shuffle_partitions(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).alias("id"),
        (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("crc"),
        F.xxhash64(body).alias("h"),
    )
    rows = rows.repartitionByRange(parts, *ORDER).withColumn("part", F.spark_partition_id())
    return settled(rows, "shard-rows")


def with_prefix_sums(rows: DataFrame) -> DataFrame:
    """``before``: bytes of all earlier rows; ``place``: number of all earlier rows."""
    totals = rows.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)).alias("rows_before"),
    )
    inside = Window.partitionBy("part").orderBy(*ORDER)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("_sum", F.sum("size").over(upto))
        .withColumn("_no", F.row_number().over(inside))
        .join(F.broadcast(offsets), "part")  # one row per partition
        .withColumn("before", F.col("bytes_before") + F.col("_sum") - F.col("size"))
        .withColumn("place", F.col("rows_before") + F.col("_no") - 1)
        .drop("_sum", "_no", "bytes_before", "rows_before")
    )


def cut_points(summed: DataFrame, shards: int, whole_below: float) -> list[int]:
    """Where each shard starts, in bytes: equal targets, moved off a group of equal texts to its nearer
    end if the group is smaller than ``whole_below`` of a shard.  At most ``shards`` rows reach the driver."""
    total = summed.agg(F.sum("size")).first()[0] or 0
    targets = [total * k // shards for k in range(shards)]
    spot = F.array(*[F.lit(t) for t in targets[1:]]) if shards > 1 else F.array().cast("array<bigint>")
    cut_groups = (
        summed.withColumn("_cuts", F.filter(spot, lambda c: (c > F.col("before")) & (c < F.col("before") + F.col("size"))))
        .union(
            # a cut between two rows of one group touches it as well
            summed.withColumn("_cuts", F.filter(spot, lambda c: c == F.col("before")))
        )
        .where(F.size("_cuts") > 0)
        .select(*GROUP, F.explode("_cuts").alias("cut"))
        .distinct()
    )
    spans = (
        summed.join(F.broadcast(cut_groups), GROUP)  # one row per cut
        .groupBy(*GROUP, "cut")
        .agg(F.min("before").alias("low"), F.max(F.col("before") + F.col("size")).alias("high"))
        .collect()
    )
    moved = {}
    for s in spans:
        if s["high"] - s["low"] <= whole_below * total / shards:
            moved[s["cut"]] = s["low"] if s["cut"] - s["low"] <= s["high"] - s["cut"] else s["high"]
        else:  # too large to keep whole: cut before the row that the target falls into
            moved[s["cut"]] = s["low"] + (s["cut"] - s["low"]) // s["size"] * s["size"]
    return [moved.get(t, t) for t in targets]


def shard_by_bytes(
    docs: DataFrame,
    shards: int,
    id_column: str = "doc_id",
    text: str = "text",
    whole_below: float = 0.02,
) -> DataFrame:
    """One row per document: ``id``, ``size``, ``crc``, ``shard`` and ``slot`` (gapless in its shard).

    A size is the UTF-8 bytes of the text (null: none) plus ``ROW_BYTES``.  Shards are contiguous in
    the order of text hash and id and differ by one row, or by a group of equal texts that lies on a
    cut and is smaller than ``whole_below`` of a shard: such groups are not parted, larger ones are.
    Null ids come first among equal texts; repeated rows get places of their own; other columns don't
    matter; with fewer rows than shards some shards stay empty, and an empty table gives no rows.
    """
    summed = settled(with_prefix_sums(ordered_rows(docs, id_column, text)), "shard-sums")
    starts = cut_points(summed, shards, whole_below)
    line = F.array(*[F.lit(s).cast("long") for s in starts])
    rows = summed.withColumn("shard", (F.size(F.filter(line, lambda s: s <= F.col("before"))) - 1).cast("int"))
    first = rows.groupBy("shard").agg(F.min("place").alias("first_place"))
    return rows.join(F.broadcast(first), "shard").select(  # one row per shard
        "id", "size", "crc", "shard", (F.col("place") - F.col("first_place")).alias("slot")
    )
