from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from landflow.llm import exact_dedup, sharding
from tests.llm.conftest import answers, in_order


@pytest.mark.parametrize("keep", ["max", "min"])
def test_labels_equal_brute_force(documents, rows, keep):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    want = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        best = {"max": max, "min": min}[keep](ids) if ids else None
        want.append((i, best, len(groups[t or ""]), i == best, hashlib.sha256((t or "").encode()).hexdigest()))
    found = exact_dedup.label_duplicates(documents, keep=keep)
    assert answers(found, "id", "keep_id", "group_size", "kept", "text_sha256") == in_order(want)


def test_every_text_stays_once(documents, rows):
    kept = exact_dedup.drop_duplicates(documents)
    assert kept.columns == documents.columns
    texts = [r["text"] or "" for r in kept.select("doc_id", "text").collect()]
    assert sorted(texts) == sorted({t or "" for _, t in rows})


@pytest.mark.parametrize("few", [exact_dedup.FEW_ROWS, 0])
def test_whole_rows_are_not_sorted(documents, rows, monkeypatch, few):
    """pipeline: sorts of whole texts, for a join and for an aggregation, took the memory of an executor."""
    monkeypatch.setattr(exact_dedup, "FEW_ROWS", few)
    best = {}
    for i, t in rows:
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
    found = exact_dedup.drop_duplicates(documents).select("doc_id", "text").collect()
    assert {r["text"] or "": -1 if r["doc_id"] is None else r["doc_id"] for r in found} == best and len(found) == len(best)
    single = documents.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).localCheckpoint()
    frame = exact_dedup.drop_duplicates(single)
    assert frame.count() == single.select(F.coalesce("text", F.lit(""))).distinct().count()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and plan.count("Exchange hashpartitioning") == (0 if few else 2)


def test_merging_does_not_depend_on_the_number_of_rounds(documents):
    results = [answers(exact_dedup.label_duplicates(documents, rounds=r), "id", "keep_id", "group_size") for r in (1, 2, 4)]
    assert results[0] == results[1] == results[2]


def test_nodes_are_partitions(spark):
    """After the last round every node holds its own digests, none shares a task with another."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('text ', id div 2) AS text")
    entries = exact_dedup.digest_entries(docs, "doc_id", "text")
    runs = exact_dedup.merged_runs(entries, 2)
    goal = F.pmod("check", F.lit(exact_dedup.ARITY**2))
    seen = runs.select(goal.alias("node"), F.spark_partition_id().alias("part"), "n").distinct().collect()
    assert sorted((r["node"], r["part"]) for r in seen) == [(k, k) for k in range(16)]
    assert {r["n"] for r in seen} == {2}


def test_built_in_functions_only(documents):
    plan = exact_dedup.label_duplicates(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_no_rows(no_documents):
    assert exact_dedup.label_duplicates(no_documents).collect() == []
    assert exact_dedup.drop_duplicates(no_documents).collect() == []
    assert sharding.shard_by_bytes(no_documents, 3).collect() == []


@pytest.mark.parametrize("shards", [1, 4, 500])
def test_shards(documents, rows, shards):
    found = sharding.shard_by_bytes(documents, shards).collect()
    want = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows]
    assert in_order((r["id"], r["size"], r["crc"]) for r in found) == in_order(want)
    by = defaultdict(list)
    for r in found:
        assert 0 <= r["shard"] < shards
        by[r["shard"]].append(r)
    for members in by.values():
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    if shards == 4:
        total, largest = sum(w[1] for w in want), max(w[1] for w in want)
        assert all(abs(sum(r["size"] for r in m) - total / shards) <= largest + 0.04 * total for m in by.values())


def test_small_groups_of_equal_texts_are_not_parted(spark):
    rows = [(k, f"text {k // 3} " + "z" * 50) for k in range(3000)]
    found = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 7).collect()
    shards = defaultdict(set)
    for r in found:
        shards[r["id"] // 3].add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())
    sizes = defaultdict(int)
    for r in found:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 4 * 70


def test_one_text_holding_most_rows_is_spread(spark):
    rows = [(k, "the same" if k % 3 else f"other {k}") for k in range(3000)]
    found = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 6).collect()
    sizes = defaultdict(int)
    for r in found:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 60
