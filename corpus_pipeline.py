"""From raw documents to an encoded training mix, stage by stage.

Every stage works on all rows that the one before has kept, and each one's result is written and read
again, so a lost executor costs no more than the stage it was working on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landflow.llm import chunk_bpe, exact_dedup, mixing, parity_join, quality
from landflow.llm.common import settled, table
from landflow.llm.queries import BYTE_BPE, DOMAIN, WEIGHTS, held_out, prepared

#: Duplicates are gone by then, so no document is used twice; four fifths of the tokens go in.
MIX = mixing.Mix(WEIGHTS, num=4, den=5, epochs=1)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking puts below its threshold go.  Labels held out for tests teach nothing."""
    ranker = quality.fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return quality.with_score(docs, ranker, into="__score").where("__score >= 0.5").drop("__score")


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts the one with the largest id stays."""
    return exact_dedup.drop_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 or more in five-word shingles the smallest id stays."""
    gone = parity_join.near_duplicates(docs, k=5, num=4, den=5).where("component <> id")
    return docs.join(gone.select(F.col("id").alias("__gone")).distinct(), F.col("doc_id") == F.col("__gone"), "left_anti")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in proportion to the target weights of their domain, language and source."""
    mixed = mixing.with_epochs(docs, MIX, F.expr(DOMAIN), into="__epochs")
    # a text without tokens can count one epoch more in a leaf that is used up
    return mixing.repeated(mixed.withColumn("__epochs", F.least("__epochs", F.lit(MIX.epochs))), "__epochs")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (little-endian unsigned 32-bit numbers), and the digest of what they decode to."""
    encoded = chunk_bpe.encode(docs, public_tokenizers.path(BYTE_BPE), decode=True)
    return encoded.select(
        F.col("id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", source_mix),
    ("BPE encoding", encoding),
]

#: The first stage fits a model, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on what the one before has written."""
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
