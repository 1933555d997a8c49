"""Exact top-k search by inner product, as a Voronoi kNN join.

With ``M`` the largest norm, a vector ``x`` gets one more coordinate, ``sqrt(M*M - |x|*|x|)``, and a
query gets 0 there; then larger inner products are exactly smaller Euclidean distances, and the join's
triangle bounds hold.

* Queries and data are grouped by their nearest pivot (a bounded sample of the data).
* Summaries per group (count, radius, the smallest distances to the pivot, of one row an id) give every
  query group a bound on the distance of its queries' ``k``-th neighbours.
* A data row goes to a query group only if its distance to its own pivot allows it to be that near.
* Large groups are divided: queries into blocks, data into parts.  Each unit is solved on its own by
  integer matrix products; the parts' best rows of a query meet at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landflow.llm.common import settled, shuffle_partitions
from landflow.llm.hashing import mix

#: Pivots; also the rows of the summaries.
PIVOTS = 16
#: Queries in a block and data rows in a part, about.
BLOCK, PART = 1024, 60_000
#: Data rows in one matrix product.
CHUNK = 4096
#: Rounding of distances, relative to the largest norm.
SLACK = 1e-6


def quantised(vector: Column, factor: int) -> Column:
    """``floor(factor * x)`` of every component; null for vectors that hold null or non-finite ones or none."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("long"))
    return F.when(sound & (F.size(vector) > 0), whole)


@dataclass(frozen=True)
class Space:
    """What a task needs to know about the vectors and the groups."""

    pivots: np.ndarray
    top: float
    kind: str
    low: np.ndarray | None = None  # of a data row's distance to its pivot, by query group and cell
    high: np.ndarray | None = None
    blocks: np.ndarray | None = None
    parts: np.ndarray | None = None

    def placed(self, x: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot and its distance."""
        norms = (x * x).sum(1)
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, self.top * self.top - norms))
        own = (self.pivots * self.pivots).sum(1)
        square = (norms + extra * extra)[:, None] + own - 2 * (x @ self.pivots[:, :-1].T + np.outer(extra, self.pivots[:, -1]))
        cell = square.argmin(1)
        return cell, np.sqrt(np.maximum(0, square[np.arange(len(x)), cell]))


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), kind)
    return flat.reshape(len(column), -1).astype(np.float64)


def _place(space: Space, query: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = np.asarray(batch.column(1).flatten(), np.int64).reshape(batch.num_rows, -1)
                cell, far = space.placed(flat.astype(np.float64), query)
                small = flat.astype(space.kind)
                packed = pa.array([r.tobytes() for r in small], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), packed, pa.array(cell), pa.array(far)], ["id", "v", "cell", "far"])

    return run


_PLACED = "id long, v binary, cell long, far double"


def _spread(values: np.ndarray, first: int, over: np.ndarray) -> np.ndarray:
    """A part for each row, even over the parts also where ids repeat: by id and place in the task (from ``first``)."""
    salt = np.arange(first, first + len(values)).astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
    return (mix(values.astype(np.uint64) + salt) >> np.uint64(33)).astype(np.int64) % over


def _unit(group: np.ndarray, block: np.ndarray, part: np.ndarray) -> np.ndarray:
    return (group << 44) | (block << 22) | part


def _send_queries(space: Space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            ids, group = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            block = _spread(ids, seen, space.blocks[group])
            seen += len(ids)
            rows = np.repeat(np.arange(len(ids)), space.parts[group])
            part = np.arange(len(rows)) - np.repeat(np.cumsum(space.parts[group]) - space.parts[group], space.parts[group])
            unit = _unit(group[rows], block[rows], part)
            yield pa.RecordBatch.from_arrays([pa.array(unit), pa.array(ids[rows]), batch.column(1).take(pa.array(rows))], ["unit", "id", "v"])

    return run


def _send_data(space: Space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            ids, cell, far = (batch.column(c).to_numpy() for c in (0, 2, 3))
            first, seen = seen, seen + len(ids)
            for group in range(len(space.blocks)):
                near = np.flatnonzero((far >= space.low[group, cell]) & (far <= space.high[group, cell]))
                if not space.blocks[group] or not len(near):
                    continue
                part = _spread(ids, first, np.full(len(ids), space.parts[group]))[near]
                for block in range(space.blocks[group]):
                    unit = _unit(np.full(len(near), group), np.full(len(near), block), part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(unit), pa.array(ids[near]), batch.column(1).take(pa.array(near))], ["unit", "id", "v"]
                    )

    return run


def _best(query_ids, queries, ids, data, k: int, wide: bool):
    """The ``k`` best rows of each query: (query row, id, score), ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, data = ids[order], data[order]
    rows, cols, scores = [], [], []
    for a in range(0, len(ids), CHUNK):
        part = data[a : a + CHUNK]
        score = (queries.astype(np.int64) @ part.astype(np.int64).T) if wide else (queries @ part.T).astype(np.int64)
        own = query_ids[:, None] == ids[None, a : a + CHUNK]
        place = np.arange(part.shape[0])
        if wide:  # no room for the place in the number: sort by score, then place
            pick = np.array([np.lexsort((place, -s, o))[:k] for s, o in zip(score, own, strict=True)])
        else:
            key = score * part.shape[0] + (part.shape[0] - 1 - place)
            key[own] = np.iinfo(np.int64).min + 1
            pick = np.argpartition(-key, k - 1, axis=1)[:, :k] if part.shape[0] > k else np.tile(place, (len(queries), 1))
        row = np.repeat(np.arange(len(queries)), pick.shape[1])
        pick = pick.ravel()
        good = ~own[row, pick]
        rows.append(row[good])
        cols.append(pick[good] + a)
        scores.append(score[row, pick][good])
    row, col, score = (np.concatenate(c) for c in (rows, cols, scores))
    order = np.lexsort((col, -score, row))
    row, col, score = row[order], col[order], score[order]
    first = np.searchsorted(row, row)  # rows are sorted: where each query begins
    keep = np.arange(len(row)) - first < k
    return row[keep], ids[col[keep]], score[keep]


def _solve(space: Space, k: int, wide: bool):
    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("query", pa.binary()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not queries.num_rows or not data.num_rows:
            return schema.empty_table()
        queries, data = queries.combine_chunks(), data.combine_chunks()
        names = queries.column("id").to_numpy()
        row, ids, score = _best(
            names,
            _matrix(queries.column("v").combine_chunks(), space.kind),
            data.column("id").to_numpy(),
            _matrix(data.column("v").combine_chunks(), space.kind),
            k,
            wide,
        )
        return pa.table(
            [pa.array(names[row]), queries.column("v").combine_chunks().take(pa.array(row)), pa.array(ids), pa.array(score)],
            schema=schema,
        )

    return run


def bounds(space: Space, cells: pd.DataFrame, groups: pd.DataFrame, nearest: pd.DataFrame, k: int) -> Space:
    """The space with each query group's distance bound turned into ranges, blocks and parts."""
    n = len(space.pivots)
    apart = np.sqrt(np.maximum(0, ((space.pivots[:, None] - space.pivots[None]) ** 2).sum(-1)))
    count = np.zeros(n, np.int64)
    count[cells["cell"].to_numpy(np.int64)] = cells["n"]
    asked, radius = np.zeros(n, np.int64), np.zeros(n)
    asked[groups["cell"].to_numpy(np.int64)] = groups["n"]
    radius[groups["cell"].to_numpy(np.int64)] = groups["radius"]
    of, far = nearest["cell"].to_numpy(np.int64), nearest["far"].to_numpy()
    low, high, parts = np.zeros((n, n)), np.zeros((n, n)), np.ones(n, np.int64)
    slack = SLACK * (1 + space.top)
    for g in range(n):
        reach = np.sort(radius[g] + apart[g, of] + far)  # upper bounds of distances to rows of distinct ids
        bound = reach[k] if len(reach) > k else np.inf  # one of them may have the query's id
        low[g] = apart[g] - radius[g] - bound - slack
        high[g] = apart[g] + radius[g] + bound + slack
        parts[g] = max(1, -(-int(count[low[g] <= high[g]].sum()) // PART))
    blocks = -(-asked // BLOCK)
    return Space(space.pivots, space.top, space.kind, low, high, blocks, parts)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector: str = "embedding",
    factor: int = 64,
    pivots: int = PIVOTS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's ``k`` best rows.

    Scores are inner products of the quantised vectors; ties go to the smaller id.  Queries are the
    rows for which ``is_query`` holds; candidates are all rows but those with the query's own id.
    Vectors that are null, empty, hold null or non-finite components or differ in length from the
    commonest length (ties: the longest) take no part, nor do rows without an id.  Repeated rows are
    candidates as often as they come; repeated queries are asked once.  Fewer than ``k`` candidates
    give fewer rows; an empty table gives none.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        quantised(F.col(f"`{vector}`"), factor).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
    ).where("id is not null and v is not null")
    rows = settled(rows, "vectors")
    largest = F.array_max(F.transform("v", F.abs))
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    about = rows.groupBy(F.size("v").alias("length")).agg(F.count(F.lit(1)).alias("n"), F.max(largest).alias("largest"), F.max(norm).alias("norm"))
    shape = about.orderBy(F.desc("n"), F.desc("length")).first()
    kinds = "query_id long, query binary, vec_id long, score long"
    if shape is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = rows.where(F.size("v") == shape["length"])
    kind = "<i1" if shape["largest"] < 128 else "<i2" if shape["largest"] < 1 << 15 else "<i8"
    wide = shape["length"] * shape["largest"] ** 2 * CHUNK >= 1 << 62 or shape["length"] * shape["largest"] ** 2 >= 1 << 53
    top = float(np.sqrt(shape["norm"]))
    drawn = rows.select("id").distinct().orderBy(F.xxhash64("id", F.lit(1)), "id").limit(pivots).collect()  # at most ``pivots`` rows
    sample = rows.where(F.col("id").isin([r["id"] for r in drawn])).groupBy("id").agg(F.min("v").alias("v")).collect()
    centre = np.array([r["v"] for r in sample], np.float64)
    extra = np.sqrt(np.maximum(0, top * top - (centre * centre).sum(1)))
    space = Space(np.unique(np.column_stack([centre, extra]), axis=0), top, kind)

    placed = settled(rows.select("id", "v").mapInArrow(_place(space, False), _PLACED), "placed")
    asked = rows.where("asked").select("id", "v").dropDuplicates()
    asked = settled(asked.mapInArrow(_place(space, True), _PLACED), "asked")
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).toPandas()  # a row per pivot
    groups = asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius")).toPandas()
    by_distance = Window.partitionBy("cell").orderBy("far")
    # a query's own id is no candidate however often it comes, so an id counts once: where it is nearest to its pivot
    once = placed.groupBy("id").agg(F.min_by("cell", "far").alias("cell"), F.min("far").alias("far"))
    nearest = once.select("cell", "far").withColumn("_no", F.row_number().over(by_distance)).where(F.col("_no") <= k + 1)
    space = bounds(space, cells, groups, nearest.toPandas(), k)  # k + 1 rows per pivot

    parts = shuffle_partitions(spark)
    sent = asked.mapInArrow(_send_queries(space), "unit long, id long, v binary")
    data = placed.mapInArrow(_send_data(space), "unit long, id long, v binary")
    found = (
        sent.repartition(parts, "unit")
        .groupBy("unit")
        .cogroup(data.repartition(parts, "unit").groupBy("unit"))
        .applyInArrow(_solve(space, k, wide), kinds)
    )
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
