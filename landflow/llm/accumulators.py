"""Ranked lexical search, term at a time, with a limit on who gets an accumulator.

An item's terms are taken rarest first, in tiers of one term, one term, two, four and so on.  An
accumulator (item, document) is created for every document of a term, as long as a document not yet
seen could still be among the best: the terms to come are worth at most the sum of their bounds (weight
times the largest contribution of a posting).  When this sum falls below the k-th best partial score, the
item is closed to new documents.  Those that could still reach that score are the survivors; the rest
of their terms is looked up for them alone, so the postings of common words are never spread over items.
All numbers are integers, and the bounds only leave out what can't be in the result: it is exact.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landflow.llm.common import settled, text_of
from landflow.llm.hashing import blocks

#: A term: the longest run of characters that are no ASCII sign, control character or blank.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM = re.compile(TERM.encode("ascii"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of the map of the items' terms: its size is fixed, however many terms there are.
BITS = 1 << 22
#: Saturation and length normalisation, in whole numbers.
SCALE, UNIT, LENGTH, PART = 1_000_000_000, 1000, 20, 50


def terms_of(column: Column) -> Column:
    return F.regexp_extract_all(F.translate(column, _UPPER, _LOWER), F.lit(TERM), F.lit(0))


def _term_map(terms: DataFrame) -> np.ndarray:
    """A bit for each term's checksum: at most ``BITS / 64`` numbers reach the driver."""
    places = terms.select((F.crc32(F.col("term").cast("binary")) % BITS).alias("at"))
    words = places.selectExpr("cast(at div 64 as int) as word", "shiftleft(1L, cast(at % 64 as int)) as bit")
    found = np.zeros(BITS // 64, np.int64)
    for row in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        found[row["word"]] = row["bits"]
    return found


def _counted(batches: Iterator[pa.RecordBatch], wanted: Broadcast) -> Iterator[pa.RecordBatch]:
    """Number of terms of each text, and how often it has those that the map knows."""
    bits = np.unpackbits(wanted.value.view(np.uint8), bitorder="little").tobytes()
    for batch in batches:
        for first, texts in blocks(batch.column(1).to_pylist()):
            n, names, tfs, ends = [], [], [], [0]
            for text in texts:
                terms = _TERM.findall(text.lower())
                n.append(len(terms))
                for term, tf in Counter(terms).items():
                    if bits[zlib.crc32(term) % BITS]:
                        names.append(term)
                        tfs.append(tf)
                ends.append(len(names))
            ends = pa.array(ends, pa.int32())
            names = pa.ListArray.from_arrays(ends, pa.array(names, pa.binary()).cast(pa.string()))
            tfs = pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))
            ids = batch.column(0).slice(first, len(texts))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), names, tfs], ["doc_id", "n", "terms", "tfs"])


def _best(scored: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each item: Spark cuts each task's rows before they are shuffled."""
    at = Window.partitionBy("item").orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(at)).where(F.col("rank") <= k)


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents above score 0 for each item.

    Each row of ``items`` is a query of its own and each row of ``docs`` a document of its own, also
    where ids repeat or are null; ties go to the smaller ``doc_id``, null ids last.  Null and empty
    texts have no terms, and as items no result.  Other columns don't matter; empty tables give an empty result.
    """
    spark = docs.sparkSession
    queries = items.select(F.col(f"`{item_column}`").alias("item_id"), F.array_distinct(terms_of(text_of(f"`{item_text}`"))).alias("terms"))
    queries = settled(queries.withColumn("item", F.monotonically_increasing_id()), "items")
    wanted = queries.select("item", F.explode("terms").alias("term"))
    vocabulary = wanted.select("term").distinct()
    known = spark.sparkContext.broadcast(_term_map(vocabulary))
    texts = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    counted = texts.mapInArrow(partial(_counted, wanted=known), f"doc_id {kind}, n long, terms array<string>, tfs array<bigint>")
    counted = settled(counted.where("n > 0").withColumn("doc", F.monotonically_increasing_id()), "counted")
    total = counted.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()

    saturation = F.expr(f"100 - {PART} + (({PART} * n * {total['docs']}L) div {total['terms'] or 1}L)")
    postings = (
        counted.select("doc", saturation.alias("m"), F.explode(F.arrays_zip("terms", "tfs")).alias("p"))
        .select("doc", F.col("p.terms").alias("term"), F.expr(f"({SCALE}L * p.tfs) div ({UNIT} * p.tfs + {LENGTH} * m)").alias("part"))
        .join(vocabulary, "term")  # what only shares a bit with a term goes
    )
    postings = settled(postings, "postings")
    weight = F.floor(F.lit(1000) * F.log((2.0 * total["docs"] + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("part").alias("peak"))
    line = Window.partitionBy("item").orderBy("df", "term")
    plan = wanted.join(weights, "term").withColumn("w", weight).withColumn("at", F.row_number().over(line))
    plan = plan.select("item", "term", "w", "at", (F.col("w") * F.col("peak")).alias("bound"))
    plan = settled(plan, "plan")

    last = plan.agg(F.max("at")).first()[0] or 0
    open_, sums, survivors = queries.select("item"), None, []
    begin, end = 1, 1
    while begin <= last:
        now = plan.where(F.col("at").between(begin, end)).join(open_, "item", "left_semi")
        fresh = now.join(postings, "term").select("item", "doc", (F.col("w") * F.col("part")).alias("score"))
        rows = fresh if sums is None else sums.unionByName(fresh)
        sums = settled(rows.groupBy("item", "doc").agg(F.sum("score").alias("score")), "accumulators")
        kth = _best(sums.where("score > 0"), k, F.desc("score")).where(F.col("rank") == k).select("item", F.col("score").alias("kth"))
        left = plan.groupBy("item").agg(F.coalesce(F.sum(F.when(F.col("at") > end, F.col("bound"))), F.lit(0)).alias("left"))
        state = left.join(kth, "item", "left").select("item", "left", F.coalesce("kth", F.lit(-1)).alias("kth"))
        state = settled(open_.join(state, "item"), "state")
        able = sums.join(state, "item").where("score + left >= kth")
        done = (F.col("left") < F.col("kth")) | (F.col("left") == 0)
        survivors.append(able.where(done).select("item", "doc", "score", F.lit(end).alias("after")))
        sums = able.where(~done).select("item", "doc", "score")
        open_ = state.where(~done).select("item")
        begin, end = end + 1, min(last, 2 * end)
    if not survivors:
        return spark.createDataFrame([], f"item_id {queries.schema['item_id'].dataType.simpleString()}, rank int, doc_id {kind}, score long")

    rest = survivors[0]
    for more in survivors[1:]:
        rest = rest.unionByName(more)
    rest = settled(rest, "survivors")
    # an item's own terms; written, so that Spark can split the survivors of one item when it joins them
    later = settled(plan.groupBy("item").agg(F.collect_list(F.struct("at", "term", "w")).alias("plan")), "later")
    asked = rest.join(later, "item").select("item", "doc", "after", F.explode("plan").alias("t")).where("t.at > after")
    asked = asked.select("item", "doc", F.col("t.term").alias("term"), F.col("t.w").alias("w"))
    added = asked.join(postings, ["doc", "term"]).select("item", "doc", (F.col("w") * F.col("part")).alias("score"))
    scores = rest.select("item", "doc", "score").unionByName(added).groupBy("item", "doc").agg(F.sum("score").alias("score"))
    named = scores.where("score > 0").join(counted.select("doc", "doc_id"), "doc")
    best = _best(named, k, F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("doc"))
    return best.join(queries.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search_sql(k: int = 50) -> str:
    """DuckDB SQL for :func:`rank_documents` over ``documents`` and ``benchmark``."""
    terms = lambda c: f"regexp_extract_all(translate({c}, '{_UPPER}', '{_LOWER}'), '{TERM}')"
    return f"""
        WITH d AS (SELECT row_number() OVER () AS doc, doc_id, {terms("text")} AS ts FROM documents),
        s AS (SELECT count(*) AS docs, CAST(sum(len(ts)) AS BIGINT) AS terms FROM d WHERE len(ts) > 0),
        i AS (SELECT row_number() OVER () AS item, item_id, list_distinct({terms("text")}) AS ts FROM benchmark),
        q AS (SELECT item, item_id, unnest(ts) AS term FROM i),
        o AS (SELECT doc, doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS term FROM d),
        p AS (SELECT doc, doc_id, n, term, count(*) AS tf FROM o WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term),
        r AS (
            SELECT item, item_id, doc, doc_id, CAST(sum(w * (({SCALE} * tf) //
                   ({UNIT} * tf + {LENGTH} * (100 - {PART} + (({PART} * n * docs) // terms))))) AS BIGINT) AS score
            FROM q JOIN w USING (term) JOIN p USING (term) CROSS JOIN s GROUP BY ALL)
        SELECT item_id, CAST(row_number() OVER b AS INTEGER) AS rank, doc_id, score FROM r WHERE score > 0
        WINDOW b AS (PARTITION BY item ORDER BY score DESC, doc_id)
        QUALIFY row_number() OVER b <= {k}"""
