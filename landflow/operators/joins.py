"""Key joins between a batch and a published table.

Keys are matched on their normalised text.  Sides that may hold many rows per
key are reduced to one row per key (or to distinct rows) by map-side aggregation
first, so a hot key costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landflow.functions import clean
from landflow.functions.enrich import row_hash
from landflow.operators.projection import cols, quoted

#: Stands for a missing key date.
DATE_KEY_DEFAULT = "1900-01-01"


def key_columns(keys: Sequence[str], date_keys: Iterable[str] = ()) -> dict[str, Column]:
    """Normalised key texts named ``_k0, _k1, ...``."""
    dates = set(date_keys)
    return {
        f"_k{i}": clean.normalized_key(F.col(quoted(k)), DATE_KEY_DEFAULT if k in dates else "")
        for i, k in enumerate(keys)
    }


def with_keys(df: DataFrame, keys: Sequence[str], date_keys: Iterable[str] = ()) -> DataFrame:
    """Add the key texts; a frame that has them keeps them, and its partitioning by them."""
    wanted = key_columns(keys, date_keys)
    return df if set(wanted) <= set(df.columns) else df.withColumns(wanted)


#: Bits of a bitmap, as Spark's bitmap functions make them.
BITMAP = 1 << 15


def bit_filter(hashes: DataFrame, name: str, size: int) -> DataFrame:
    """A bit for each 64-bit hash, of ``size`` in all (a power of two, a bitmap's at least), as rows of bitmaps."""
    at = F.col(name).bitwiseAND(F.lit(size - 1))
    placed = hashes.select(F.floor(at / BITMAP).alias("_bitmap"), (at % BITMAP).alias("_at"))
    return placed.repartition("_bitmap").groupBy("_bitmap").agg(F.bitmap_construct_agg("_at").alias("_bits"))


def by_bit(df: DataFrame, bits: DataFrame, size: int, hashed: Column, is_set: bool) -> DataFrame:
    """Rows whose hash has its bit in a :func:`bit_filter` set, or the others.

    Equal hashes are always on the same side; an unlike one may share the bit of one that was put in.  The bitmaps
    are broadcast: ``size`` bits at most.
    """
    at = hashed.bitwiseAND(F.lit(size - 1))
    placed = df.withColumns({"_bitmap": F.floor(at / BITMAP), "_at": (at % BITMAP).cast("int")})
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, F.col("_at") % 8) == 1, F.lit(False))
    return placed.join(F.broadcast(bits), "_bitmap", "left").where(found if is_set else ~found).select(*cols(df.columns))


def _current(target: DataFrame, flag: str) -> DataFrame:
    return target.filter(F.trim(F.col(quoted(flag))) == "Y")


def expire_join(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    marker: str,
    flag: str = "is_current_fg",
    date_keys: Sequence[str] = (),
    null_safe: bool = True,
) -> DataFrame:
    """Current target rows for which the batch holds the same key with another marker.

    Only the least and greatest marker of a key matter: the key has another
    marker exactly when one of them differs.  A null marker differs from every
    other; ``null_safe=False`` compares literally, so that null differs from nothing.
    """
    names = list(key_columns(keys))
    m = F.col(quoted(marker))
    per_key = with_keys(staging, keys, date_keys).groupBy(*names).agg(
        F.min(m).alias("_lo"), F.max(m).alias("_hi"), F.count_if(m.isNull()).alias("_nulls")
    )
    joined = with_keys(_current(target, flag), keys, date_keys).join(per_key, names)
    differs = F.coalesce((F.col("_lo") != m) | (F.col("_hi") != m), F.lit(False))
    if null_safe:
        differs = (
            differs
            | (m.isNull() & F.col("_lo").isNotNull())
            | (m.isNotNull() & (F.col("_nulls") > 0))
        )
    return joined.filter(differs).select(*cols(target.columns))


def insert_left_join(
    staging: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    marker: str,
    flag: str = "is_current_fg",
    date_keys: Sequence[str] = (),
    null_safe: bool = True,
) -> DataFrame:
    """Batch rows without a current target row of their key, or with another marker.

    The target is reduced to one row per key first, with its least and greatest marker, so a key with
    several current rows returns a batch row once: if any of them has another marker.
    """
    names = list(key_columns(keys))
    m = F.col(quoted(marker))
    live = with_keys(_current(target, flag), keys, date_keys).groupBy(*names).agg(
        F.min(m).alias("_lo"), F.max(m).alias("_hi"), F.count_if(m.isNull()).alias("_nulls"),
        F.count(m).alias("_values"), F.lit(True).alias("_found"),
    )
    joined = with_keys(staging, keys, date_keys).join(live, names, "left")
    differs = F.coalesce((F.col("_lo") != m) | (F.col("_hi") != m), F.lit(False))
    if null_safe:
        differs = differs | F.when(m.isNull(), F.col("_values") > 0).otherwise(F.col("_nulls") > 0)
    return joined.filter(F.col("_found").isNull() | differs).select(*cols(staging.columns))


def insert_not_exists(
    staging: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    marker: str,
    flag: str = "is_current_fg",
    date_keys: Sequence[str] = (),
    null_safe: bool = True,
) -> DataFrame:
    """Batch rows whose key and marker no current target row has; null equals null unless ``null_safe`` is off."""
    names = list(key_columns(keys))
    live = (
        with_keys(_current(target, flag), keys, date_keys)
        .select(*names, F.col(quoted(marker)).alias("_m"))
        .distinct()
    )
    batch = with_keys(staging, keys, date_keys).withColumn("_m", F.col(quoted(marker)))
    if null_safe:
        # an extra equal-or-not column keeps the null-safe comparison a hash join key
        live = live.withColumn("_mn", F.col("_m").isNull())
        batch = batch.withColumn("_mn", F.col("_m").isNull())
        live = live.withColumn("_m", F.coalesce(F.col("_m").cast("string"), F.lit("")))
        batch = batch.withColumn("_m", F.coalesce(F.col("_m").cast("string"), F.lit("")))
        names = [*names, "_mn"]
    return batch.join(live, [*names, "_m"], "left_anti").select(*cols(staging.columns))


def replay_join(
    batch: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    watermark: str,
    hash_column: str,
    keep: str = "replayed",
) -> DataFrame:
    """Batch rows already in the target by key, watermark and hash - or, ``keep='fresh'``, the others."""
    on = [*keys, watermark, hash_column]
    seen = target.select(*cols(on)).distinct()
    how = {"replayed": "left_semi", "fresh": "left_anti"}[keep]
    return batch.join(seen, on, how).select(*cols(batch.columns))


def hash_verify(
    df: DataFrame, hash_column: str, columns: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Rows whose stored hash is missing or unlike the recomputed one."""
    stored = F.col(quoted(hash_column))
    return df.filter(stored.isNull() | (stored != row_hash(columns, null_safe)))


def calendar_lookup(
    df: DataFrame,
    calendar: DataFrame,
    date_column: str,
    output: str = "fiscal_quarter",
    calendar_date: str = "date",
    year: str = "fiscal_year",
    quarter: str = "fiscal_year_quarter",
) -> DataFrame:
    """Fiscal quarter and two-digit year of a row's date, null when the calendar lacks it."""
    days = calendar.select(
        F.col(quoted(calendar_date)).alias("_day"),
        F.concat(F.col(quoted(quarter)), F.right(F.col(quoted(year)), F.lit(2))).alias(output),
    )
    day = F.col(quoted(date_column)).cast("date")
    return df.withColumn("_day", day).join(days, "_day", "left").drop("_day")
