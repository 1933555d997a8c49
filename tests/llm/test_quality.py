from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from landflow.llm import quality
from landflow.llm.queries import BUILDS


@pytest.fixture(scope="module")
def labelled(spark):
    draw = random.Random(1)
    words = ["stone", "river", "moon", "light", "tree", "walk", "seven", "often"]
    rows = []
    for k in range(600):
        text = " ".join(draw.choice(words) for _ in range(draw.randrange(5, 60)))
        poor = k % 4 == 0
        if poor:
            text = draw.choice([text.upper() + "!!!", text.replace(" ", "$$$ "), " ".join([text.split()[0]] * 30)])
        rows.append((k, text, int(not poor)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_held_out_rows_are_told_apart(labelled):
    learn, rest = labelled.where("doc_id % 3 <> 1"), labelled.where("doc_id % 3 = 1")
    ranker = quality.fit(labelled.select("doc_id", "text"), learn)
    right = quality.with_score(rest, ranker).where((F.col("score") >= 0.5) == (F.col("quality") == 1)).count()
    assert right >= 0.97 * rest.count()


def test_the_threshold_is_a_quantile_of_the_scores(labelled):
    rows = labelled.collect()
    x, y = np.array([quality.features(r["text"]) for r in rows]), np.array([r["quality"] for r in rows])
    y[:60] = 1 - y[:60]  # noise: the share of rejected ones stays that of the poor ones
    scores = quality.fit_rows(x, y).scores(x)
    assert abs((scores < 0.5).mean() - (y == 0).mean()) < 0.01


def test_newton_finds_the_least_loss():
    draw = np.random.default_rng(0)
    better, worse = draw.normal(0.5, 1, (400, 3)), draw.normal(0, 1, (400, 3))
    loss = lambda w: np.log1p(np.exp(-(better - worse) @ w)).mean() + 5e-4 * w @ w
    w = quality.fit_pairs(better, worse)
    assert all(loss(w) <= loss(w + step) for step in 1e-3 * np.vstack([np.eye(3), -np.eye(3)]))


def test_odd_rows(spark, documents, no_documents, rows):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(50)] + [(None, 1, 0), (3, None, 1), (4, 7, 1)], "doc_id long, quality int, n int")
    ranker = quality.fit(documents, labels)
    scored = quality.with_score(documents, ranker)
    assert set(scored.columns) == set(documents.columns)
    found = scored.select("text", "score").collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    empty = {r["score"] for r in found if not r["text"]}
    assert len(empty) == 1
    assert quality.with_score(no_documents, ranker).collect() == []


def test_without_labels_nothing_is_rejected(documents, no_documents):
    labels = documents.select("doc_id", F.lit(1).alias("quality"))
    for ranker in (quality.fit(documents, labels), quality.fit(no_documents, labels), quality.fit(documents, labels.where("false"))):
        assert {r["score"] for r in quality.with_score(documents, ranker).select("score").collect()} == {0.5}


def test_query(spark, sf_dir):
    rows = BUILDS["op1_quality_ranking"](spark, sf_dir).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.9 * len(held)
