"""The registered queries of this subpackage: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landflow.llm import (
    accumulators,
    chosen_path,
    chunk_bpe,
    exact_dedup,
    mixing,
    parity_join,
    prefix_free,
    quality,
    rotation,
    sharding,
    token_counts,
    voronoi_knn,
    warc,
)
from landflow.llm.common import scratch_path, table, text_of
from landflow.session import configure

Build = Callable[[SparkSession, str], DataFrame]

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
CONTEXT_TOKENS = 2048
SHARDS = 24

BUILDS: dict[str, Build] = {}
SQL: dict[str, str] = {}


def prepared(spark: SparkSession) -> SparkSession:
    """Arrow batches of whole texts must be small: a worker holds a few of them at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return configure(spark)


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        BUILDS[name] = lambda spark, sf_dir: build(prepared(spark), sf_dir)
        if sql:
            SQL[name] = sql
        return build

    return add


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels no model may learn from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


@query("op1_quality_ranking")
def op1_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ranker = quality.fit(docs, labels.where(~held_out()))
    return quality.with_score(docs, ranker).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


#: Domains by the number that ends a source's name; weights by domain, language and source.
DOMAIN = """CASE WHEN regexp_extract(source, '([0-9]+)$', 1) = '' THEN 'other'
                 WHEN CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) < 10 THEN 'web'
                 WHEN CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) < 15 THEN 'reference'
                 ELSE 'forum' END"""
WEIGHTS = ({"web": 5, "reference": 3, "forum": 2}, {"en": 6, "de": 2, "fr": 2}, {"src0": 2})
MIX = mixing.Mix(WEIGHTS, num=1, den=2, epochs=4)


@query("op2_source_mix", mixing.mix_sql(MIX, DOMAIN))
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return mixing.with_epochs(docs, MIX, F.expr(DOMAIN)).select(
        "doc_id",
        F.coalesce(F.expr(DOMAIN), F.lit("")).alias("domain"),
        blank("lang").alias("lang"),
        blank("source").alias("source"),
        F.regexp_count(text_of(), F.lit(mixing.WORD)).cast("long").alias("n_tokens"),
        "epochs",
    )


@query(
    "op3_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
              doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
       FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.label_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.with_token_counts(docs, public_tokenizers.path(WORD_BPE))
    return counted.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > CONTEXT_TOKENS).alias("over_limit"),
    )


@query("op5_warc_revisits")
def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    rows = warc.with_payload_size(warc.read_archives(spark, path))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "sound")


@query("op6_prefix_free")
def op6_prefix_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_free.remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op7_parity_join")
def op7_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parity_join.near_duplicates(table(spark, sf_dir, "documents"), k=3, num=9, den=10)
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@query(
    "op8_voronoi_knn",
    """WITH v AS (
           SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
       scored AS (
           SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
       SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
       WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
       QUALIFY row_number() OVER w <= 20""",
)
def op8_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi_knn.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op9_byte_shards")
def op9_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)
    return rows.select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op10_chunk_bpe")
def op10_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def token_digests(docs: DataFrame) -> DataFrame:
    encoded = chunk_bpe.encode(docs, public_tokenizers.path(BYTE_BPE), decode=True)
    return encoded.select(
        F.col("id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op11_chosen_path")
def op11_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chosen_path.near_duplicates(table(spark, sf_dir, "documents"), k=4, num=4, den=5)
    return rows.select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept")
    )


@query("op12_accumulator_search", accumulators.search_sql())
def op12_accumulator_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accumulators.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_block_rotation", rotation.rotation_sql())
def op13_block_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rotation.fill_in_middle(table(spark, sf_dir, "documents"), check=True)
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return rows.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))
