"""Exact duplicates by a tree-merge of sorted digest runs.  Built-in functions only.

Every row becomes a digest entry.  Each of the ``ARITY ** rounds`` *nodes* first reduces its own
rows to a run: one entry per text, with the id to keep and the number of rows.  Then the nodes
exchange runs in binomial rounds: in round ``r`` a node swaps the ``r``-th digit of its number for
the digit that the digest names, so that ``ARITY`` nodes that differ in this digit alone exchange
parts of their sorted runs, and each merges what it receives, entry by entry.  After the last round
every text has one entry, and each node holds its share of the digests; no node ever holds all.

An entry is verified at every level: texts meet only if SHA-256, length and an independent 64-bit
hash all agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landflow.llm.common import settled, shuffle_partitions, text_of

#: Runs that meet in one merge.
ARITY = 4
DIGEST = ["digest", "bytes", "check"]
#: Digests of rows to drop, of about a hundred bytes each, that are broadcast at most.
FEW_ROWS = 100_000


def rounds_for(partitions: int) -> int:
    """Rounds after which there are as many nodes as partitions, at least."""
    rounds = 1
    while ARITY**rounds < partitions:
        rounds += 1
    return rounds


def _digit(number: Column, place: int) -> Column:
    return F.floor(number / ARITY**place).cast("long") % ARITY


def digest_entries(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """One row per document: its id and the verified digest of its text."""
    body = text_of(text)
    return docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.sha2(body.cast("binary"), 256).alias("digest"),
        F.octet_length(body).alias("bytes"),
        F.xxhash64(body).alias("check"),
    )


def merged_runs(entries: DataFrame, rounds: int, keep: str = "max") -> DataFrame:
    """One row per text: verified digest, ``keep_id`` (null only if all its ids are) and ``n`` rows."""
    pick = {"max": F.max, "min": F.min}[keep]
    home = F.pmod(F.xxhash64("id"), F.lit(ARITY**rounds))
    goal = F.pmod(F.col("check"), F.lit(ARITY**rounds))
    runs = (
        entries.withColumn("node", home)
        .groupBy("node", *DIGEST)
        .agg(pick("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    )
    for place in range(rounds):
        step = (_digit(goal, place) - _digit(F.col("node"), place)) * ARITY**place
        runs = (
            runs.withColumn("node", (F.col("node") + step).cast("int"))
            .repartitionById(ARITY**rounds, "node")  # a node is a partition
            .sortWithinPartitions("node", *DIGEST)
            .groupBy("node", *DIGEST)
            .agg(pick("keep_id").alias("keep_id"), F.sum("n").alias("n"))
        )
    return runs.drop("node")


def label_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", keep: str = "max", rounds: int | None = None
) -> DataFrame:
    """One row per document: ``id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Of identical texts the row with the largest id stays (``keep="min"``: the smallest).  Null and
    empty texts are one text.  A null id stays only where its group has no other id; repeated rows
    of the id that stays are all marked as kept, since they cannot be told apart.  Other columns
    don't matter; an empty table gives an empty result.

    Only texts with two rows or more go back to the rows, in a join that Spark splits for large groups.
    """
    rounds = rounds or rounds_for(shuffle_partitions(docs.sparkSession))
    entries = digest_entries(docs, id_column, text)
    groups = merged_runs(entries, rounds, keep).where("n > 1")
    found = entries.alias("e").join(groups.alias("g"), DIGEST, "left")
    keep_id = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return found.select(
        "id",
        keep_id.alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", keep: str = "max") -> DataFrame:
    """The rows of ``docs`` that stay, each text once, all columns unchanged.

    Rows that repeat id and text are reduced to one.  The digests of the rows that go are written first: Spark
    broadcasts up to ``FEW_ROWS`` of them, so whole rows stay where they are; with more, rows are shuffled once and pass
    a hash table of these digests.  Whole rows are sorted only where id and text repeat.
    """
    rounds = rounds_for(shuffle_partitions(docs.sparkSession))
    name = lambda c: F.coalesce(F.col(f"`{c}`").cast("long").cast("string"), F.lit(""))
    keys = ["__name", "__digest"]  # of a repeated row only; a large group of copies has as many keys as rows
    copies = label_duplicates(docs, id_column, text, keep, rounds).where("group_size > 1")
    named = copies.select(name("id").alias("__name"), F.col("text_sha256").alias("__digest"), "kept")
    # a copy goes, or stays but is there more than once
    told = named.groupBy(*keys).agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n")).where("n > 1 OR NOT stays")
    told = settled(told.drop("n"), "copies")
    many, repeating = told.agg(F.count(F.lit(1)), F.count_if("stays")).first()
    how = "broadcast" if many <= FEW_ROWS else "shuffle_hash"
    digest = F.coalesce(F.sha2(text_of(text).cast("binary"), 256), F.lit(""))  # not null: both joins can read one shuffle
    rows = docs.withColumns({"__name": name(id_column), "__digest": digest})
    found = rows.join(told.select(*keys).hint(how), keys, "left_anti")
    if repeating:
        again = rows.join(told.where("stays").select(*keys).hint(how), keys, "left_semi").dropDuplicates(keys)
        found = found.unionAll(again)
    return found.select(*[f"`{c}`" for c in docs.columns])
