"""The pipeline's stages, one after the other, each against a plain version on its own input."""

from __future__ import annotations

import hashlib

import corpus_pipeline as pipeline
import numpy as np
from pyspark.sql import functions as F

from landflow.llm.common import settled, table
from landflow.llm.queries import prepared
from tests.llm.conftest import in_order
from tests.llm.test_mixing import filled
from tests.llm.test_similarity import brute_components
from tests.llm.test_tokens import BYTES, library


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, sf_dir):
    docs = table(prepared(spark), sf_dir, "documents")
    columns, seen = docs.columns, [docs]
    for name, stage in pipeline.STAGES:
        seen.append(settled(stage(spark, seen[-1], sf_dir), name.replace(" ", "-")))
    raw, good, exact, near, mixed, encoded = seen
    assert all(df.columns == columns for df in (good, exact, near, mixed))

    # quality: labelled documents are told apart, and nothing else happens to a row
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf_dir, "labels").collect()}
    kept = dict(pairs(good))
    assert set(pairs(good)) <= set(pairs(raw))
    right = [(i in kept) == (labels[i] == 1) for i, _ in pairs(raw) if i in labels]
    assert np.mean(right) >= 0.95

    # exact: the largest id of each text
    largest = {}
    for i, text in pairs(good):
        largest[text] = max(i, largest.get(text, -1))
    assert in_order(pairs(exact)) == in_order((i, t) for t, i in largest.items())

    # near: the smallest id of each component
    want = {c for _, _, c in brute_components(pairs(exact), 5, 4, 5)}
    assert sorted(i for i, _ in pairs(near)) == sorted(want)

    # mix: four fifths of the tokens at most, none twice, and no leaf beyond its share
    words = lambda t: len([w for w in t.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w])
    available, used = sum(words(t) for _, t in pairs(near)), sum(words(t) for _, t in pairs(mixed))
    assert len(set(pairs(mixed))) == mixed.count() and set(pairs(mixed)) <= set(pairs(near))
    assert used <= 0.8 * available
    domain = F.expr(pipeline.DOMAIN)
    supply = {r["d"]: r["n"] for r in near.groupBy(domain.alias("d")).agg(F.sum(F.regexp_count("text", F.lit(r"[^ \t\n\r]+"))).alias("n")).collect()}
    share = {r["d"]: r["n"] for r in mixed.groupBy(domain.alias("d")).agg(F.sum(F.regexp_count("text", F.lit(r"[^ \t\n\r]+"))).alias("n")).collect()}
    grants = filled(available * 4 // 5, supply, {d: pipeline.WEIGHTS[0].get(d, 1) for d in supply})
    assert all(share[d] <= grants[d] for d in share)

    # encoding: the library's ids, which decode to the text
    rows = pairs(mixed)
    want = [(i, np.array(e, "<u4").tobytes(), hashlib.sha256(t.encode()).hexdigest()) for (i, t), e in zip(rows, library(BYTES, [t for _, t in rows]), strict=True)]
    found = encoded.select("doc_id", "ids", "decoded_sha256").collect()
    assert in_order((r["doc_id"], bytes(r["ids"]), r["decoded_sha256"]) for r in found) == in_order(want)


def test_the_mix_uses_no_blank_document_twice(spark):
    """src0 is used up; some of its blank documents come before the one with tokens in the next order."""
    rows = [(k, "", "en", "src0") for k in range(40)] + [(99, "a b", "en", "src0"), (100, "a " * 500, "en", "src11")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    used = [r.doc_id for r in pipeline.source_mix(spark, docs, "").collect()]
    assert len(used) == len(set(used)) and set(range(40)) | {99} == set(used)


def test_stages_take_odd_rows(spark, sf_dir, documents, no_documents):
    for docs in (documents, no_documents):
        odd = docs.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"), "key", "component")
        for name, stage in pipeline.STAGES:
            odd = settled(stage(spark, odd, sf_dir), name.replace(" ", "-"))
            if name != pipeline.STAGES[-1][0]:
                assert odd.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "component"]
