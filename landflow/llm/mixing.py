"""Mixing sources to target weights by hierarchical budgets.  Built-in functions only.

The documents form a tree (domain, language, source).  The budget goes down the tree by weight among
siblings.  A child that can't use its share (its tokens times the allowed epochs) takes what it can,
and its siblings share the rest by weight; only what a whole family can't use was never given to it,
so it went to the parent's siblings: siblings come before ancestors.  Each leaf then takes whole
epochs of its documents and, of a seeded order for the next epoch, the longest prefix that its
remaining tokens allow.

Only sums per leaf and per slice of its order are shuffled, not texts: a leaf's prefix ends at a key,
and a document is in it if its own key is not larger.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landflow.llm.common import settled, text_of

WORD = r"[^ \t\n\r]+"


@dataclass(frozen=True)
class Mix:
    """``weights`` has, for each level, whole-number weights by name; names not listed weigh ``default``.

    The budget is ``num / den`` of all tokens.  Weights and tokens multiply within 63 bits.
    """

    weights: tuple[dict[str, int], ...] = ({}, {}, {})
    num: int = 1
    den: int = 2
    epochs: int = 1
    seed: int = 17
    default: int = 1
    levels: tuple[str, ...] = field(default=("domain", "lang", "source"))


def weight_of(name: Column, weights: dict[str, int], default: int) -> Column:
    found = F.lit(default)
    for key, weight in weights.items():
        found = F.when(name == key, weight).otherwise(found)
    return found.cast("long")


def allotted(children: DataFrame, parent: list[str], weight: Column, name: str) -> DataFrame:
    """``granted`` to each child, from ``budget`` (its parent's) and ``supply``.

    Children are filled in the order of supply per weight: one is full if the budget left, shared by
    weight among it and those after it, covers its supply; the others share what the full ones leave.
    """
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = family.orderBy(F.col("supply") / F.col("weight"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("supply").over(before), F.lit(0))
    rows = children.withColumn("weight", weight).withColumn(
        "full", F.col("supply") * F.sum("weight").over(after) <= F.col("weight") * left
    )
    full_supply = F.sum(F.when(F.col("full"), F.col("supply")).otherwise(0)).over(family)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(family)
    rows = rows.withColumn("_rest", F.col("budget") - full_supply).withColumn("_open", open_weight)
    share = F.expr("(weight * _rest) div _open")
    return rows.withColumn("granted", F.when(F.col("full"), F.col("supply")).otherwise(share)).drop(
        "weight", "full", "_rest", "_open", "budget"
    )


def leaf_grants(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``granted`` tokens of every leaf (columns: the levels, ``tokens``)."""
    leaves = leaves.withColumn("supply", F.col("tokens") * mix.epochs)
    # the root: one row
    root = leaves.agg(
        F.least((F.sum("tokens") * mix.num / mix.den).cast("long"), F.sum("supply")).alias("budget")
    )
    above, parent = root, []
    for level, weights in zip(mix.levels, mix.weights, strict=True):
        path = [*parent, level]
        children = leaves.groupBy(*path).agg(F.sum("supply").alias("supply"))
        joined = children.join(above, parent) if parent else children.join(F.broadcast(above))  # one row
        above = allotted(joined, parent, weight_of(F.col(level), weights, mix.default), level)
        above = above.select(*path, F.col("granted").alias("budget"))
        parent = path
    return above.withColumnRenamed("budget", "granted").join(leaves.select(*mix.levels, "tokens"), list(mix.levels))


def order_key(mix: Mix, epoch: Column, doc_id: Column) -> Column:
    """A document's place in the order of an epoch, as 32 hexadecimal digits."""
    parts = F.concat_ws("|", F.lit(str(mix.seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.md5(parts.cast("binary"))


def with_epochs(
    docs: DataFrame,
    mix: Mix,
    domain: Column,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    into: str = "epochs",
) -> DataFrame:
    """``docs`` with the number of times that the mix uses each document (0: not at all).

    Tokens are words between white space.  A null domain, language or source is the name ``""``; a
    null or empty text has no tokens and is used whenever its leaf takes part in the last epoch.  No
    document is used more than ``mix.epochs`` times: a leaf that is used up begins no further epoch.  A
    leaf without tokens or grant uses its documents 0 times.  Rows that share an id share its place, so
    repeated rows are used alike; rows without an id share one place.  Other columns are kept (those
    named like ``into`` replaced); an empty table stays empty.
    """
    named = {
        "__domain": F.coalesce(domain, F.lit("")),
        "__lang": F.coalesce(F.col(f"`{lang}`"), F.lit("")),
        "__source": F.coalesce(F.col(f"`{source}`"), F.lit("")),
    }
    path = list(named)
    tree = Mix(mix.weights, mix.num, mix.den, mix.epochs, mix.seed, mix.default, tuple(path))
    keyed = docs.withColumns(named)
    words = F.regexp_count(text_of(text), F.lit(WORD)).cast("long")
    slim = settled(keyed.select(F.col(f"`{id_column}`").alias("id"), *path, words.alias("tokens")), "mix-tokens")
    leaves = settled(slim.groupBy(*path).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    grants = leaf_grants(leaves, tree)
    whole = F.when(F.col("tokens") > 0, F.expr("granted div tokens")).otherwise(0)
    grants = grants.withColumn("whole", whole).withColumn("rest", F.col("granted") - F.col("whole") * F.col("tokens"))
    grants = settled(grants.select(*path, "whole", "rest"), "mix-grants")

    placed = slim.join(grants, path).withColumn("key", order_key(mix, F.col("whole") + 1, F.col("id")))
    placed = placed.select(*path, "rest", "key", "tokens", F.substring("key", 1, 3).alias("slice"))
    slices = placed.groupBy(*path, "rest", "slice").agg(F.sum("tokens").alias("tokens"))
    upto = Window.partitionBy(*path).orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)  # 4096 slices at most
    slices = slices.withColumn("upto", F.sum("tokens").over(upto))
    partly = slices.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("tokens") <= F.col("rest")))
    # a slice that ends a prefix is looked at row by row: about a 4096th of its leaf
    ends = placed.join(
        partly.select(*path, "slice", (F.col("upto") - F.col("tokens")).alias("before")), [*path, "slice"]
    )
    running = F.sum("tokens").over(Window.partitionBy(*path, "slice").orderBy("key")) + F.col("before")
    inner = ends.withColumn("_sum", running).where(F.col("_sum") <= F.col("rest")).select(*path, "key")
    through = slices.where(F.col("upto") <= F.col("rest")).select(*path, F.concat("slice", F.lit("g")).alias("key"))
    cut = inner.unionByName(through).groupBy(*path).agg(F.max("key").alias("__cut"))
    table = settled(grants.join(cut, path, "left").select(*path, F.col("whole").alias("__whole"), "__cut"), "mix-cuts")
    key = order_key(mix, F.col("__whole") + 1, F.col(f"`{id_column}`"))
    another = (F.col("__whole") < mix.epochs) & (key <= F.col("__cut"))
    used = F.col("__whole") + F.when(another, 1).otherwise(0)
    return keyed.join(table, path).withColumn(into, used.cast("int")).drop(*path, "__whole", "__cut")


def repeated(docs: DataFrame, epochs: str = "epochs") -> DataFrame:
    """Every document as often as ``epochs`` says, without that column."""
    times = F.when(F.col(epochs) > 0, F.sequence(F.lit(1), F.col(epochs)))
    return docs.withColumn("__nth", F.explode(times)).drop("__nth", epochs)


def mix_sql(mix: Mix, domain: str) -> str:
    """DuckDB SQL for ``doc_id`` and ``epochs``; ``domain`` is an SQL expression over ``source``."""

    def weight(column: str, weights: dict[str, int]) -> str:
        cases = " ".join(f"WHEN {column} = '{k}' THEN {w}" for k, w in weights.items())
        return f"(CASE {cases} ELSE {mix.default} END)" if cases else str(mix.default)

    ctes, parent, above = [], [], "root"
    for nth, (level, weights) in enumerate(zip(("domain", "lang", "source"), mix.weights, strict=True)):
        path = [*parent, level]
        cols, family = ", ".join(path), ", ".join(parent) or "1"
        join = f"JOIN {above} USING ({', '.join(parent)})" if parent else "CROSS JOIN root"
        ctes.append(
            f"""c{nth} AS (SELECT {cols}, sum(supply) AS supply FROM leaves GROUP BY {cols}),
            w{nth} AS (SELECT c.*, budget, {weight(level, weights)} AS weight FROM c{nth} c {join}),
            f{nth} AS (SELECT *, supply * sum(weight) OVER (PARTITION BY {family} ORDER BY supply / weight, {level}
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) <= weight * (budget - coalesce(sum(supply) OVER
                 (PARTITION BY {family} ORDER BY supply / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 AS is_full FROM w{nth}),
            g{nth} AS (SELECT {cols}, CASE WHEN is_full THEN supply ELSE
                 (weight * (budget - sum(CASE WHEN is_full THEN supply ELSE 0 END) OVER (PARTITION BY {family})))
                 // nullif(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (PARTITION BY {family}), 0) END AS budget FROM f{nth})"""
        )
        parent, above = path, f"g{nth}"
    levels = ", ".join(parent)
    return f"""WITH slim AS (SELECT doc_id, coalesce({domain}, '') AS domain, coalesce(lang, '') AS lang,
            coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+')) AS tokens FROM documents),
        leaves AS (SELECT {levels}, sum(tokens) AS tokens, sum(tokens) * {mix.epochs} AS supply FROM slim GROUP BY {levels}),
        root AS (SELECT least(sum(tokens) * {mix.num} // {mix.den}, sum(supply)) AS budget FROM leaves),
        {", ".join(ctes)},
        e AS (SELECT g.*, tokens AS leaf_tokens, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole
              FROM g2 g JOIN leaves USING ({levels})),
        k AS (SELECT slim.*, whole, budget - whole * leaf_tokens AS rest,
              md5(concat_ws('|', '{mix.seed}', whole + 1, coalesce(CAST(doc_id AS VARCHAR), 'null'))) AS key
              FROM slim JOIN e USING ({levels})),
        s AS (SELECT *, sum(tokens) OVER (PARTITION BY {levels} ORDER BY key) AS upto FROM k)
        SELECT doc_id, domain, lang, source, tokens AS n_tokens,
               CAST(whole + CASE WHEN upto <= rest AND whole < {mix.epochs} THEN 1 ELSE 0 END AS INTEGER) AS epochs FROM s"""
