"""Duplicate rows and duplicate keys.

Copies of one row may make up a large share of the input, so nothing here sends
a whole group to one task: groups are counted with map-side aggregation, and
only the count is turned back into rows, in pieces of bounded size.

Whole records are compared by 128-bit fingerprints first.  Only these are shuffled for all rows; records
whose fingerprint recurs are then compared by their content, so equal fingerprints of unlike records
do no harm, and wide rows travel only where there are copies.
"""

from __future__ import annotations

import enum
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landflow.operators.projection import cols

#: Rows one task writes out for one counted group before the group is split.
COPIES_PER_PIECE = 100_000


def duplicate_count(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row: number of surplus copies and of duplicated groups."""
    groups = df.groupBy(*cols(names or df.columns)).agg(F.count(F.lit(1)).alias("copies"))
    return groups.filter("copies > 1").agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"),
        F.count(F.lit(1)).alias("duplicate_groups"),
    )


def drop_duplicates(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(names)) if names else df.distinct()


def counted_copies(df: DataFrame, copies: str) -> DataFrame:
    """The distinct rows, each with the number of its copies."""
    return df.groupBy(*cols(df.columns)).agg(F.count(F.lit(1)).alias(copies))


def _repeat(df: DataFrame, count: Column) -> DataFrame:
    """Every row ``count`` times."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), count)))


def expand_copies(df: DataFrame, copies: str, piece: int = COPIES_PER_PIECE) -> DataFrame:
    """Repeat each row ``copies`` times, dropping the counter.

    A row's copies are cut into pieces of at most ``piece``, which are spread over the cluster before
    they are written out.
    """
    names = [c for c in df.columns if c != copies]
    n = F.col(copies)
    pieces = df.filter(n > 0).withColumn("_piece", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / piece))))
    sized = pieces.withColumn("_size", F.least(F.lit(piece), n - F.col("_piece") * piece))
    # a number is given because adaptive execution would merge these small partitions
    # again: it sees the size of the pieces, not of the rows they stand for
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = sized.repartition(tasks, *cols(names), F.col("_piece"))
    return _repeat(spread, F.col("_size")).select(*cols(names))


def fingerprint(names: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a record; which of its values are null is part of both."""
    values = cols(names)
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in values])
    return [F.xxhash64(F.lit(seed), nulls, *values).alias(f"_f{seed}") for seed in (1, 2)]


_FINGER = ["_f1", "_f2"]


def _recurring(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Fingerprints that more than one row has, counted before they are shuffled."""
    counted = df.select(*fingerprint(names)).groupBy(*_FINGER).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.filter("_rows > 1").select(*_FINGER)


def _marked(df: DataFrame) -> DataFrame:
    return df.select(*cols(df.columns), *fingerprint(df.columns))


def surplus_duplicates(df: DataFrame, piece: int = COPIES_PER_PIECE) -> DataFrame:
    """The second and further copies of every row (input minus its distinct rows)."""
    candidates = _marked(df).join(_recurring(df, df.columns), _FINGER, "left_semi")
    counted = candidates.groupBy(*cols(df.columns)).agg(F.count(F.lit(1)).alias("_copies"))
    surplus = counted.filter("_copies > 1").withColumn("_copies", F.col("_copies") - 1)
    return expand_copies(surplus, "_copies", piece)


def minus_all(left: DataFrame, right: DataFrame, piece: int = COPIES_PER_PIECE) -> DataFrame:
    """Multiset difference: each right row removes one equal left row.

    Left rows with a fingerprint that no right row has stay where they are; the others of both sides are
    compared by content.
    """
    names = left.columns
    right = right.select(*cols(names))
    prints = lambda df: df.select(*fingerprint(names)).distinct()
    theirs = prints(right)
    kept = _marked(left).join(theirs, _FINGER, "left_anti").select(*cols(names))
    common = _marked(left).join(theirs, _FINGER, "left_semi").select(*cols(names), F.lit(1).alias("_sign"))
    removing = _marked(right).join(prints(left), _FINGER, "left_semi").select(*cols(names), F.lit(-1).alias("_sign"))
    counted = common.unionAll(removing).groupBy(*cols(names)).agg(F.sum("_sign").alias("_copies"))
    return kept.unionAll(expand_copies(counted.filter("_copies > 0"), "_copies", piece))


def business_key_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their count."""
    return df.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("key_count")).filter("key_count > 1")


def priority_dedup(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """First row per key by ``order``, ties settled by all remaining columns.

    ``row_number() = 1`` lets the optimizer keep one row per key on the map
    side, so a hot key never travels whole.
    """
    rest = tiebreak if tiebreak is not None else [c for c in df.columns if c not in set(keys)]
    window = Window.partitionBy(*cols(keys)).orderBy(*order, *cols(rest))
    ranked = df.withColumn("_row_num", F.row_number().over(window))
    return ranked.filter("_row_num = 1").drop("_row_num")


class DuplicatePolicy(str, enum.Enum):
    """What happens to surplus copies of a row."""

    SKIP = "skip"
    DROP = "drop"
    TOLERATE = "tolerate"
    REJECT = "reject"


#: ``allow_duplicates`` of a configuration: 0 drops, 1 tolerates, -1 rejects.
ALLOW_DUPLICATES = {0: DuplicatePolicy.DROP, 1: DuplicatePolicy.TOLERATE, -1: DuplicatePolicy.REJECT}


def choose_policy(
    region: str, by_region: Mapping[str, str], allow_duplicates: int = -1
) -> DuplicatePolicy:
    """Entity's own entry for the region (any case), else its general setting."""
    named = {k.lower(): v for k, v in by_region.items()}.get(region.lower())
    return DuplicatePolicy(named) if named else ALLOW_DUPLICATES[allow_duplicates]


# How a rejected copy of a row is reported.
REJECT_REASON = "row level duplicate"
REJECT_COLUMN = "Full Record"


def row_duplicate_policy(df: DataFrame, policy: DuplicatePolicy) -> tuple[DataFrame, DataFrame]:
    """``(kept, rejected)``; rejected rows carry a reason and a column name.

    Where copies are rejected, kept rows and copies come from one count of the records, so a plan with
    both shuffles whole rows once.
    """

    def stamped(rows: DataFrame) -> DataFrame:
        return rows.withColumns(
            {"reject_reason": F.lit(REJECT_REASON), "rejected_column": F.lit(REJECT_COLUMN)}
        )

    if policy is DuplicatePolicy.REJECT:
        counted = counted_copies(df, "_copies")
        surplus = counted.select(*cols(df.columns), (F.col("_copies") - 1).alias("_copies"))
        # asking for the count keeps it in both plans, so that they are the same up to there
        return counted.filter("_copies > 0").drop("_copies"), stamped(expand_copies(surplus, "_copies"))
    kept = drop_duplicates(df) if policy is DuplicatePolicy.DROP else df
    return kept, stamped(df.limit(0))
