"""Near-duplicate documents by a chosen-path set similarity join on word shingles.

Every set of shingles has a signature of minwise tokens.  A *tree* branches the documents by chosen
tokens: at the root by two positions of the signature, at a deeper node by one or two that the node's
own path selects, ``den / num`` on average.  Documents with the same token at a chosen position go to
the same child, so a linked pair of similarity ``num / den`` stays together in one child on average,
while unlike ones part quickly and a group that is unlike inside does not multiply.

* A node whose members are all in one component already has nothing left to find and is dropped.
* A node with few pairs of members of different components, for its size, is small: it becomes a
  leaf, in which they are compared exhaustively, a pair in the first of its leaves only.  The others branch again.
* Before that, members of a node are compared with a few of its members as pivots.  Large groups of
  near copies become one component in this way, and cost a few comparisons a member, not all pairs.
* A comparison looks at sizes, at 256 parity bits of the shingles and at a sketch of the signature, in leaves at a parity
  sketch of a bit or more for each shingle too (see ``parity_join``; parities refuse no linked pair), then confirms on the
  full sets.

Independent trees are repeated until a pair at the threshold meets, in nodes that are ``DEPTH`` levels
deep, with the probability ``recall``; at one level less than one in 10**12 is missed.
Documents with equal sets are one class from the start (128-bit name of the set).  The classes are a
table in buckets, so that a comparison moves pairs and the texts of pairs, not all texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landflow.llm.common import bucketed, settled
from landflow.llm.components import components, joined_components
from landflow.llm.hashing import blocks, mix, trim_memory
from landflow.llm.parity_join import _may_link_wide, _named, meets_first, set_name, shingle_sets, wide_sketch, with_first_keys

_U = np.uint64
#: Minwise tokens of a signature, and longs of its sketch (four bits of each token).
TOKENS, WORDS = 128, 8
#: Standard deviations by which a sketch may underestimate the similarity: 13 in 10,000 pairs right at the
#: threshold exceed it, and hardly any above (each tree and the links of neighbours give further chances).
SLACK = 3.0
#: Depth for which the number of trees is reckoned.
DEPTH = 8
#: Pairs between components that a leaf may hold for each of its members.  A pair costs twelve bit counts, a level of
#: branching a shuffle; near copies that are not linked part slowly: a level leaves seven eighths of their pairs.
SMALL = 4096
#: Bytes of text that are compared at once.
BLOCK = 1 << 19
#: Pairs of one hub (a pivot, mostly) that are confirmed in one task.
PIECE = 1024
#: Pivots of a node that its members are compared with: below the roots in two rounds, deeper in one.
PIVOTS = ((0,), (1, 2, 3))

_FACTORS = mix(np.arange(1, TOKENS + 1, dtype=np.uint64)) | _U(1)
_OFFSETS = mix(np.arange(TOKENS + 1, 2 * TOKENS + 1, dtype=np.uint64))
SKETCH = [f"s{k}" for k in range(WORDS)]
#: The parity sketch folded to 256 bits, which are compared in compiled code.
PARITY = [f"p{k}" for k in range(4)]


def trees_for(recall: float, num: int, den: int, depth: int = DEPTH) -> int:
    """Trees after which a pair of similarity ``num / den`` has met with probability ``recall``."""
    like, second = num / den, den / num - 1
    meet = 1.0
    for _ in range(depth):
        one = like * meet
        meet = (1 - second) * one + second * (2 * one - one * one)
    root = 1 - (1 - like * meet) ** 2
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - root)))


# ------------------------------------------------------------------ inside tasks


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The minwise tokens of sets that are not empty: a row of ``TOKENS`` 32-bit numbers each."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    found = np.empty((len(sets), TOKENS), np.uint32)
    for k in range(TOKENS):
        found[:, k] = np.minimum.reduceat((flat ^ _OFFSETS[k]) * _FACTORS[k], starts) >> _U(32)
    return found


def sketches(tokens: np.ndarray) -> np.ndarray:
    """Four bits of each token, packed into ``WORDS`` longs."""
    nibbles = (tokens & 15).astype(np.uint8)
    return np.ascontiguousarray(nibbles[:, 0::2] | (nibbles[:, 1::2] << 4)).view(np.int64)


_FEATURES = f"id long, n long, hi long, lo long, tokens array<int>, {', '.join(f'{s} long' for s in SKETCH + PARITY)}, wide array<bigint>, body binary"


def _features(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for first, texts in blocks(batch.column(1).to_pylist()):
            sets = shingle_sets(texts, k)
            full = [row for row, s in enumerate(sets) if len(s)]
            tokens = np.zeros((len(sets), TOKENS), np.uint32)
            if full:
                tokens[full] = signatures([sets[row] for row in full])
            names = np.array([set_name(s) for s in sets], np.int64).reshape(-1, 2)
            listed = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sets) + 1, dtype=np.int32) * TOKENS), pa.array(tokens.view(np.int32).ravel())
            )
            wide = [wide_sketch(s) for s in sets]
            folded = np.array([np.bitwise_xor.reduce(np.array(w, np.int64).reshape(-1, len(PARITY))) for w in wide]).reshape(-1, len(PARITY))
            columns = [
                batch.column(0).slice(first, len(texts)),
                pa.array(np.array([len(s) for s in sets], np.int64)),
                *[pa.array(np.ascontiguousarray(names[:, c])) for c in range(2)],
                listed,
                *[pa.array(c) for c in np.ascontiguousarray(sketches(tokens).T)],
                *[pa.array(c) for c in np.ascontiguousarray(folded.T)],
                pa.array(wide, pa.list_(pa.int64())),
                pa.array([press.compress(t) if len(s) else None for t, s in zip(texts, sets, strict=True)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "hi", "lo", "tokens", *SKETCH, *PARITY, "wide", "body"])


def _confirmed(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Those of the pairs whose full sets are linked; pairs of one hub stand next to one another."""
    unpack = zstandard.ZstdDecompressor()
    held: tuple = (None, None)
    for batch in batches:
        trim_memory()
        keep: list[bool] = []
        hub, left, right = batch.column(0).to_pylist(), batch.column(2), batch.column(3)
        while len(keep) < batch.num_rows:
            first, texts, is_new, size = len(keep), [], [], 0
            while first + len(is_new) < batch.num_rows and size < BLOCK:
                row = first + len(is_new)
                is_new.append(hub[row] != (hub[row - 1] if is_new else held[0]))
                for side in (left, right) if is_new[-1] else (right,):
                    texts.append(unpack.decompress(side[row].as_py()))
                    size += len(texts[-1])
            sets = iter(shingle_sets(texts, k))
            for row, new in enumerate(is_new, first):
                held = (hub[row], next(sets)) if new else held
                other = next(sets)
                both = len(np.intersect1d(held[1], other, assume_unique=True))
                keep.append(den * both >= num * (len(held[1]) + len(other) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


# ------------------------------------------------------------------ comparisons


def _unequal_tokens(a: str, b: str) -> Column:
    """Tokens whose four bits differ in the sketches of two sides."""
    parts = []
    for s in SKETCH:
        x = f"({s}_{a} ^ {s}_{b})"
        x = f"({x} | shiftrightunsigned({x}, 2))"
        x = f"({x} | shiftrightunsigned({x}, 1))"
        parts.append(f"bit_count({x} & {0x1111111111111111}L)")
    return F.expr(" + ".join(parts))


def _may_link(num: int, den: int) -> Column:
    """Sizes allow a link, and the sketches don't speak against it; the parity sketch refuses no linked pair."""
    alike = num / den
    agree = alike + (1 - alike) / 16
    most = TOKENS * (1 - agree) + SLACK * math.sqrt(TOKENS * agree * (1 - agree))
    sizes = F.expr(f"least(n_a, n_b) * {den} >= greatest(n_a, n_b) * {num}")
    odd = " + ".join(f"bit_count({p}_a ^ {p}_b)" for p in PARITY)
    parity = F.expr(f"({odd}) * {den + num} <= (n_a + n_b) * {den - num}")
    return sizes & parity & (_unequal_tokens("a", "b") <= int(most))


def _side(rows: DataFrame, side: str, *more: str) -> DataFrame:
    return rows.select(*more, *[F.col(c).alias(f"{c}_{side}") for c in ("rep", "n", *SKETCH, *PARITY)])


class _Links:
    """What has been compared, and the components that the links found so far make."""

    def __init__(self, classes: DataFrame, shared: DataFrame, k: int, num: int, den: int):
        self.classes, self.k, self.num, self.den = classes, k, num, den
        self.tried: DataFrame | None = None
        self.labels = components(shared)

    def with_component(self, rows: DataFrame) -> DataFrame:
        labels = self.labels.select(F.col("id").alias("rep"), "component")
        return rows.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    def candidates(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (``member``, ``hub``) that may be linked; a hub can have a large share of them."""
        members = pairs.join(_side(self.classes, "a"), F.col("member") == F.col("rep_a"))
        hubs = pairs.select("hub").distinct().join(_side(self.classes, "b"), F.col("hub") == F.col("rep_b"))
        return members.join(hubs, "hub").where(_may_link(self.num, self.den)).select("member", "hub")

    def confirm(self, pairs: DataFrame) -> None:
        """Compare the full sets of ``pairs``, each pair once, and join the components of linked ones."""
        pairs = pairs.select(F.least("member", "hub").alias("a"), F.greatest("member", "hub").alias("b"), "hub")
        pairs = pairs.groupBy("a", "b").agg(F.min("hub").alias("hub"))
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        pairs = settled(pairs, "pairs")
        if pairs.isEmpty():
            return
        tried = pairs.select("a", "b")
        self.tried = tried if self.tried is None else self.tried.union(tried)
        found = self._with_texts(pairs).mapInArrow(partial(_confirmed, k=self.k, num=self.num, den=self.den), "a long, b long")
        self.labels = joined_components(self.labels, settled(found, "links"))

    def _with_texts(self, pairs: DataFrame) -> DataFrame:
        """``hub, member, left, right``; the text of a hub of many pairs is sent to a task for each piece of them."""
        body = lambda side, name: self.classes.select(F.col("rep").alias(side), F.col("body").alias(name))
        sizes = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PIECE)
        large = settled(sizes.select("hub", F.ceil(F.col("n") / PIECE).alias("pieces")), "hubs")
        other = F.when(F.col("hub") == F.col("a"), F.col("b")).otherwise(F.col("a"))
        named = pairs.select("hub", other.alias("member")).join(large, "hub", "left")
        rows = named.join(body("member", "right"), "member")
        few = rows.where("pieces is null").join(body("hub", "left"), "hub")
        texts = large.join(body("hub", "left"), "hub")
        texts = texts.select("hub", "left", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
        piece = F.pmod(F.xxhash64("member"), F.col("pieces"))
        many = rows.where("pieces is not null").withColumn("piece", piece).join(texts, ["hub", "piece"])
        columns = ["hub", "member", "left", "right"]
        return few.select(*columns).union(many.sortWithinPartitions("hub").select(*columns))


def _roots(classes: DataFrame, trees: int) -> DataFrame:
    """``key, rep``: the two children of each tree's root that a class goes to."""
    keys = [F.xxhash64(F.lit(at), F.element_at("tokens", at % TOKENS + 1)) for at in range(2 * trees)]
    return classes.select("rep", F.explode(F.array(*keys)).alias("key"))


def _children(entries: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The children that the members of branching nodes go to: one or two positions, chosen by the path."""
    position = lambda c: F.pmod(F.xxhash64("key", F.lit(c)), F.lit(TOKENS)).cast("int")
    child = lambda c: F.xxhash64("key", F.lit(c), F.element_at("tokens", position(c) + 1))
    second = F.pmod(F.xxhash64("key", F.lit(-1)), F.lit(num)) < den - num
    both = F.array_compact(F.array(child(0), F.when(second & (position(0) != position(1)), child(1))))
    return entries.join(classes.select("rep", "tokens"), "rep").select("rep", F.explode(both).alias("key"))


def _unfinished(entries: DataFrame, links: _Links) -> DataFrame:
    """The entries of nodes with more than one component, with ``component`` and the nodes' numbers."""
    named = links.with_component(entries.select("key", "rep"))
    groups = named.groupBy("key", "component").agg(F.count(F.lit(1)).cast("double").alias("c"))
    nodes = groups.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.sum("c").alias("members"), F.sum(F.col("c") * F.col("c")).alias("within"))
    nodes = nodes.where("parts > 1").select("key", "members", ((F.col("members") * F.col("members") - F.col("within")) / 2).alias("between"))
    return named.join(nodes, "key")


def _pivots(entries: DataFrame, slots: tuple[int, ...]) -> DataFrame:
    """Pairs of members and pivots of different components: for each slot the member with the least hash."""
    least = [F.min(F.struct(F.xxhash64("rep", "key", F.lit(slot)).alias("h"), "rep", "component")) for slot in slots]
    chosen = entries.groupBy("key").agg(F.array(*least).alias("pivots"))
    other = F.filter("pivots", lambda p: p["component"] != F.col("component"))
    pairs = entries.join(chosen, "key").select("rep", F.explode(F.transform(other, lambda p: p["rep"])).alias("pivot"))
    return pairs.select(F.col("rep").alias("member"), F.col("pivot").alias("hub")).where("member != hub").distinct()


def _within_leaves(leaves: DataFrame, links: _Links) -> DataFrame:
    """All pairs of a leaf's members that are in different components and may be linked."""
    facts = links.classes.select("rep", "n", *SKETCH, *PARITY, "wide")
    members = with_first_keys(settled(links.with_component(leaves), "leaves"))
    members = settled(members.join(facts, "rep"), "members")
    more = ("component", "firsts", "wide")
    one, two = (_side(members, side, "key", *[F.col(c).alias(f"{c}_{side}") for c in more]) for side in "ab")
    apart = (one["key"] == two["key"]) & (F.col("component_a") < F.col("component_b"))
    wide = _may_link_wide(links.num, links.den, _named("a"), _named("b"))
    pairs = one.join(two, apart & _may_link(links.num, links.den) & meets_first(one["key"]) & wide)
    return pairs.select(F.greatest("rep_a", "rep_b").alias("member"), F.least("rep_a", "rep_b").alias("hub"))


# ------------------------------------------------------------------ the join


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    k: int = 5,
    num: int = 4,
    den: int = 5,
    recall: float = 0.999,
) -> DataFrame:
    """One row per document: ``id``, ``n_shingles`` and ``component`` (smallest id reachable by links).

    Two documents are linked if the Jaccard similarity of their sets of ``k``-word shingles (words as in
    ``shingle_sets``) is ``num / den`` or more; every link reported is confirmed on the full sets, and a
    link is found with a probability of at least ``recall`` (see above).  A null or empty text, or one of
    blanks, has an empty set and is linked with nothing.  Rows with one id are one node with the links of
    all its texts; rows without an id have component null and are linked with nothing.  Repeated rows are
    returned as often as they come; other columns don't matter; an empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    features = rows.mapInArrow(partial(_features, k=k), _FEATURES).withColumn("row", F.monotonically_increasing_id())
    features = settled(features, "features")
    facts = ["n", "tokens", *SKETCH, *PARITY, "wide", "body"]
    least = F.min(F.struct("id", "row")).alias("least")
    chosen = features.where("n > 0 and id is not null").groupBy("hi", "lo").agg(least)
    chosen = chosen.select(F.col("least.row").alias("row"), F.col("least.id").alias("low"))
    classes = features.select("row", "hi", "lo", *facts).join(chosen, "row").withColumnRenamed("row", "rep")
    classes = bucketed(classes, "rep", "classes")
    names = features.select("id", "n", "hi", "lo")
    ids = names.where("n > 0 and id is not null").select("id", "hi", "lo").distinct()
    many = ids.groupBy("id").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1").select("id")
    ids_in = settled(ids.join(many, "id", "left_semi").join(classes.select("hi", "lo", "rep"), ["hi", "lo"]).select("id", "rep"), "mixed")
    shared = ids_in.join(ids_in.groupBy("id").agg(F.min("rep").alias("a")), "id").select("a", F.col("rep").alias("b"))
    links = _Links(classes, shared, k, num, den)

    entries, leaves = _roots(classes, trees_for(recall, num, den)), []
    while True:
        entries = settled(_unfinished(entries, links).select("key", "rep", "component"), "nodes")
        if entries.isEmpty():
            break
        for slots in PIVOTS if not leaves else [sum(PIVOTS, ())]:
            links.confirm(links.candidates(_pivots(entries, slots)))
            entries = settled(_unfinished(entries, links), "nodes")
            small = F.col("between") <= SMALL * F.col("members")
            leaf, branching = entries.where(small).select("key", "rep"), entries.where(~small).select("key", "rep")
            entries = entries.select("key", "rep", "component")
        leaves.append(leaf)
        entries = _children(branching, classes, num, den)
    if leaves:
        links.confirm(_within_leaves(reduce(DataFrame.union, leaves), links))

    labels = links.labels.withColumnRenamed("id", "rep")
    least = classes.select("rep", "low").join(labels, "rep").groupBy("component").agg(F.min("low").alias("least"))
    labels = labels.join(least, "component").select("rep", "least")
    named = classes.select("hi", "lo", "rep", "low").join(labels, "rep", "left")
    named = named.select("hi", "lo", "rep", F.coalesce("least", "low").alias("component"))
    # rows whose own set is empty, though their id has others
    blank = names.where("n = 0 and id is not null").select("id").distinct()
    of_id = ids.join(blank, "id", "left_semi").join(named, ["hi", "lo"]).groupBy("id").agg(F.min("component").alias("of_id"))
    found = names.join(named, ["hi", "lo"], "left").join(of_id, "id", "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component", "of_id", "id"))
    return found.select("id", F.col("n").alias("n_shingles"), own.alias("component"))
