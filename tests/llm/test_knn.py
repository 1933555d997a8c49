from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landflow.llm import voronoi_knn
from tests.llm.conftest import answers, in_order

NAN, INF = float("nan"), float("inf")


def brute(rows, k, factor=64):
    sound = [
        (i, [math.floor(factor * x) for x in v])
        for i, v in rows
        if i is not None and v and len(v) == 6 and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in {(i, tuple(v)) for i, v in sound if i % 20 == 0}:
        scores = sorted(((-sum(x * y for x, y in zip(a, v, strict=True)), i) for i, v in sound if i != q))[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    return in_order(out)


@pytest.fixture(scope="module")
def vectors():
    draw = np.random.default_rng(4)
    centres = draw.normal(0, 1, (5, 6))
    rows = [(k, (centres[k % 5] + draw.normal(0, 0.05, 6)).tolist()) for k in range(400)]
    rows += [(k, centres[0].tolist()) for k in range(400, 600)]  # one vector many times: ties everywhere
    rows += [(600, None), (620, []), (640, [1.0] * 5), (660, [NAN] + [1.0] * 5), (680, [INF] + [1.0] * 5), (700, [None] + [1.0] * 5)]
    rows += [(None, [1.0] * 6), (720, [0.0] * 6), (740, [-30.0] * 6), (20, rows[20][1]), (7, rows[7][1])]
    return rows


def frame(spark, rows):
    full = [(i, v, 1, 2, "x") for i, v in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<double>, cell int, far int, unit string").repartition(4)


@pytest.mark.parametrize(("k", "block", "part"), [(20, 1024, 60_000), (3, 4, 50), (5000, 8, 100)])
def test_best_rows_equal_brute_force(spark, monkeypatch, vectors, k, block, part):
    monkeypatch.setattr(voronoi_knn, "BLOCK", block)
    monkeypatch.setattr(voronoi_knn, "PART", part)
    found = voronoi_knn.top_k(frame(spark, vectors), F.col("vec_id") % 20 == 0, k=k)
    assert answers(found, "query_id", "rank", "vec_id", "score") == brute(vectors, k)


@pytest.mark.parametrize("part", [60_000, 30])
def test_a_queried_id_repeated_more_than_k_times(spark, monkeypatch, part):
    """Equal norms and a pivot a vector: the copies alone would make the bound 0."""
    monkeypatch.setattr(voronoi_knn, "PART", part)
    signs = [[1.0 if n >> j & 1 else -1.0 for j in range(6)] for n in range(64)]
    rows = [(20, signs[0])] * 30 + [(20, signs[1])] * 30 + [(101 + n, v) for n, v in enumerate(signs)]
    found = voronoi_knn.top_k(frame(spark, rows), F.col("vec_id") % 20 == 0, k=20, pivots=200)
    assert answers(found, "query_id", "rank", "vec_id", "score") == brute(rows, 20)


def test_copies_of_one_id_spread_over_parts():
    wide = np.zeros((1, 1))
    space = voronoi_knn.Space(np.zeros((1, 7)), 1.0, "<i1", wide, wide + 1, np.array([1]), np.array([4]))
    rows = [pa.array([20] * 1000), pa.array([b"x"] * 1000), pa.array([0] * 1000), pa.array([0.5] * 1000)]
    sent = voronoi_knn._send_data(space)(iter([pa.RecordBatch.from_arrays(rows, ["id", "v", "cell", "far"])] * 2))
    sizes = np.unique(np.concatenate([b.column(0).to_numpy() for b in sent]), return_counts=True)[1]
    assert sizes.sum() == 2000 and len(sizes) == 4 and sizes.max() < 700


def test_large_components(spark):
    rows = [(k, [float(k * 10**5 + j) for j in range(6)]) for k in range(50)]
    found = voronoi_knn.top_k(frame(spark, rows), F.col("vec_id") % 20 == 0, k=4)
    assert answers(found, "query_id", "rank", "vec_id", "score") == brute(rows, 4)


def test_distant_groups_are_not_replicated(spark):
    """Near clusters: most data goes to the few query groups that need it."""
    draw = np.random.default_rng(2)
    centres = 50 * draw.normal(0, 1, (16, 6))
    x = np.concatenate([c + draw.normal(0, 0.1, (100, 6)) for c in centres])
    top = np.sqrt((x * x).sum(1).max())
    aug = np.column_stack([centres, np.sqrt(np.maximum(0, top * top - (centres**2).sum(1)))])
    space = voronoi_knn.Space(aug, top, "<i8")
    import pandas as pd

    cell, far = space.placed(x, False)
    cells = pd.DataFrame({"cell": cell}).groupby("cell").size().reset_index(name="n")
    asked, reach = space.placed(x[::20], True)
    groups = pd.DataFrame({"cell": asked, "far": reach}).groupby("cell").agg(n=("far", "size"), radius=("far", "max")).reset_index()
    nearest = pd.DataFrame({"cell": cell, "far": far}).sort_values("far").groupby("cell").head(21)
    sent = voronoi_knn.bounds(space, cells, groups, nearest, 20)
    pairs = sum(int(((far >= sent.low[g, cell]) & (far <= sent.high[g, cell])).sum()) for g in groups["cell"])
    assert pairs < len(x) * len(groups)


def test_no_vectors(spark, vectors):
    empty = voronoi_knn.top_k(frame(spark, vectors).where("false"), F.col("vec_id") % 20 == 0)
    assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.collect() == []
