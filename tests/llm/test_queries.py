"""Every registered query of the subpackage, on whole tables, against SQL or brute force."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from landflow.llm.queries import BUILDS, SQL
from tests import oracle
from tests.llm.conftest import in_order
from tests.llm.test_similarity import brute_components, brute_removal
from tests.llm.test_tokens import BYTES, WORDS, library


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"]) for r in rows]


def answer(spark, sf_dir, name, *columns):
    return in_order(tuple(r) for r in BUILDS[name](spark, sf_dir).select(*columns).collect())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf_dir, name):
    con = oracle.connect(sf_dir)
    assert oracle.difference(BUILDS[name](spark, sf_dir), con, SQL[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in BUILDS) == list(range(1, 14))


def test_token_counts(spark, sf_dir, texts):
    want = [
        (i, len((t or "").encode()), len(e), len(e) > 2048)
        for (i, t), e in zip(texts, library(WORDS, [t for _, t in texts]), strict=True)
    ]
    assert answer(spark, sf_dir, "op4_token_counts", "doc_id", "n_bytes", "n_tokens", "over_limit") == in_order(want)


def test_warc(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html").collect()
    first = {}
    for r in sorted(pages, key=lambda r: r["page_id"]):
        first.setdefault(r["html"] or "", r["page_id"])
    want = []
    for r in pages:
        data, own = (r["html"] or "").encode(), first[r["html"] or ""] == r["page_id"]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((r["page_id"], len(data), digest, "response" if own else "revisit", None if own else first[r["html"] or ""]))
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert answer(spark, sf_dir, "op5_warc_revisits", *columns) == in_order(want)


def test_removed_passages(spark, sf_dir, texts):
    found = answer(spark, sf_dir, "op6_prefix_free", "doc_id", "n_bytes", "n_removed", "kept_sha256")
    want = [(i, n, n - len(kept), hashlib.sha256(kept).hexdigest()) for i, n, kept in brute_removal(texts, 100)]
    assert found == in_order(want)
    assert sum(n for _, _, n, _ in found) > 0


def test_near_duplicates(spark, sf_dir, texts):
    found = answer(spark, sf_dir, "op7_parity_join", "doc_id", "n_shingles", "component_id")
    assert found == in_order(brute_components(texts, 3, 9, 10))


def test_shards(spark, sf_dir, texts):
    rows = BUILDS["op9_byte_shards"](spark, sf_dir).collect()
    want = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts]
    assert in_order((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == in_order(want)
    slots = defaultdict(list)
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 24
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_token_ids(spark, sf_dir, texts):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for (i, _), e in zip(texts, library(BYTES, [t for _, t in texts]), strict=True):
        text = own.decode(e, skip_special_tokens=False)
        ids = hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest()
        want.append((i, len(e), ids, hashlib.sha256(text.encode()).hexdigest()))
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert answer(spark, sf_dir, "op10_chunk_bpe", *columns) == in_order(want)
