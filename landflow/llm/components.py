"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landflow.llm.common import settled


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (its smallest reachable id) of every id in ``links`` (columns ``a``, ``b``: long).

    Rounds of contraction: every id takes its smallest neighbour, if that is smaller, and then the one
    that this neighbour takes; links between ids that have become one are gone, and equal ones are one.
    An id never grows, and the smallest id of a component stays, so it is what remains.  Links and
    labels are written in every round; there are fewer links each time.
    """
    edges = settled(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("id", "other")
        taken = settled(both.groupBy("id").agg(F.least("id", F.min("other")).alias("root")), "taken")
        above = taken.select(F.col("id").alias("root"), F.col("root").alias("higher"))
        taken = settled(taken.join(above, "root").select("id", F.col("higher").alias("root")), "roots")
        if labels is None:
            labels = taken.select("id", F.col("root").alias("component"))
        else:
            step = taken.select(F.col("id").alias("component"), "root")
            joined = labels.join(step, "component", "left")
            labels = settled(joined.select("id", F.coalesce("root", "component").alias("component")), "labels")
        first, second = (taken.select(F.col("id").alias(c), F.col("root").alias(f"root_{c}")) for c in ("a", "b"))
        moved = edges.join(first, "a").join(second, "b")
        moved = moved.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b"))
        edges = settled(moved.where("a < b").distinct(), "links")
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels


def joined_components(labels: DataFrame, more: DataFrame) -> DataFrame:
    """The components after more links, given those before: only components are looked at."""
    name = lambda c: labels.select(F.col("id").alias(c), F.col("component").alias(f"c_{c}"))
    between = more.join(name("a"), "a", "left").join(name("b"), "b", "left")
    between = between.select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    over = components(between).withColumnRenamed("component", "root")
    old = labels.join(over.withColumnRenamed("id", "component"), "component", "left")
    old = settled(old.select("id", F.coalesce("root", "component").alias("component")), "labels")
    new = over.join(old, "id", "left_anti").select("id", F.col("root").alias("component"))
    return old.union(settled(new, "labels"))
