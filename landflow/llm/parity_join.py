"""Near-duplicate documents by a parity-sketch join on word shingles.

Linked sets (Jaccard similarity of ``num / den`` or more) of sizes ``a`` and ``b`` differ in at most
``(a + b) * (den - num) / (den + num)`` shingles.  A *parity sketch* XORs a hash bit per shingle; each
shingle in which two sets differ changes one position, so the Hamming distance of two sketches is a
lower bound of their symmetric difference.

* Sizes are grouped in bands.  For a band with at most ``d`` differences the sketch has more than
  ``d`` segments, so a linked pair agrees in one whole segment (pigeonhole).  A set enters its own
  band, and the next lower one if a partner can be there.  A segment is very wide and nearly empty,
  so its key is the XOR of its shingles' 64-bit hashes: the same parity, stored in one number.
* Buckets of equal keys are read in sorted order; every member is paired with the bucket's first
  and, in larger buckets, with its neighbours in a few orders by sketch.  These pairs pass a Hamming
  test on a 256-bit sketch, then one on a sketch of a bit or more for each shingle, which sets with a
  passage in common fail as well, and are then verified on the texts.
* Members of a bucket that are still in different components are paired with one another, tested
  and verified too, so no link is lost; a group of copies costs a few pairs a member, not all pairs.
  A pair that meets in many buckets is made in the first of them only.

Documents with equal sets are one class from the start (128-bit hash of the set).  Pairs and links
are between classes, which have numbers of their own: an id can be in several classes, if its rows
have different texts, and these are linked with one another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landflow.llm.common import settled, shuffle_partitions
from landflow.llm.components import components, joined_components
from landflow.llm.hashing import Rolling, blocks, mix, trim_memory

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Sizes of a band's sets differ by this factor at most (more where the similarity asks for it).
BAND = 1.5
#: Segments beyond the pigeonhole's need, so that empty ones can nearly always be left out.
SPARE = 1.1
#: Least keys of a member that tell in which bucket a pair meets first.
FIRST_KEYS = 32
#: Classes a task remembers so as not to send a copy's segments again; beyond it, it forgets all.
SEEN = 200_000


# ------------------------------------------------------------------ sets of shingles


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The distinct ``k``-word shingles of each text, as sorted 64-bit hashes.

    A-Z are lower-cased; words are runs of other characters than blank and ``\\t`` to ``\\r``.  Fewer
    than ``k`` words make one shingle, none make an empty set.
    """
    data = np.frombuffer(b" " + b" ".join(texts).lower() + b" ", np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    words = Rolling(data).spans(starts, ends)
    lengths = np.array([len(t) + 1 for t in texts])
    first = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]) + 1)
    rolled = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for j in range(k):
        rolled = rolled * _U(0x9E3779B97F4A7C15) + words[j : j + len(rolled)]
    rolled = mix(rolled)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            sets.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            whole = _U(b - a)
            for word in words[a:b]:
                whole = mix(np.array([whole]) + word)[0]
            sets.append(np.array([whole], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_name(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    if not len(shingles):
        return 0, 0
    both = np.array([np.bitwise_xor.reduce(shingles), (shingles * (shingles >> _U(7) | _U(1))).sum()], np.uint64)
    hi, lo = mix(both + _U(len(shingles))).view(np.int64).tolist()
    return hi, lo


def parity_sketch(shingles: np.ndarray) -> list[int]:
    """256 parity bits in four numbers."""
    odd = np.bincount((shingles & _U(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def wide_sketch(shingles: np.ndarray) -> list[int]:
    """Parity bits in as many longs as give each shingle a bit: a power of two, 4 at least."""
    bits = 256
    while bits < len(shingles):
        bits *= 2
    odd = np.bincount((shingles & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


# ------------------------------------------------------------------ bands and segments


class Bands:
    """How sizes are banded, and how many segments a band has."""

    def __init__(self, num: int, den: int):
        if not 0 < num < den:
            raise ValueError("the similarity must lie between 0 and 1")
        self.num, self.den = num, den
        self.factor = max(BAND, den / num)
        self.lows = [1]

    def differences(self, a: int, b: int) -> int:
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def largest_partner(self, size: int) -> int:
        return size * self.den // self.num

    def of(self, size: int) -> int:
        while self.lows[-1] <= size:
            self.lows.append(int(self.lows[-1] * self.factor) + 1)
        return int(np.searchsorted(self.lows, size, "right")) - 1

    def entered(self, size: int) -> list[int]:
        """Bands in which a set of this size can meet a linked set that is not equal to it."""
        band, found = self.of(size), []
        if self.differences(size, self.largest_partner(size)) > 0:
            found.append(band)
        if band and self.largest_partner(self.lows[band] - 1) >= size and self.differences(self.lows[band] - 1, size) > 0:
            found.append(band - 1)
        return found

    def segments(self, band: int) -> tuple[int, int]:
        """(most differences, segments) of a band."""
        self.of(self.lows[-1] if len(self.lows) <= band + 1 else 1)
        most = self.lows[band + 1] - 1
        d = self.differences(most, self.largest_partner(most))
        return d, int(SPARE * (d + 1)) + 2


def segment_keys(shingles: np.ndarray, band: int, d: int, segments: int) -> np.ndarray:
    """The keys of a set's segments in a band: without empty ones if more than ``d`` are not empty."""
    at = (((shingles >> _U(32)) * _U(segments)) >> _U(32)).astype(np.int64)
    keys = np.zeros(segments, np.uint64)
    np.bitwise_xor.at(keys, at, mix(shingles))
    full = np.zeros(segments, bool)
    full[at] = True
    names = mix(keys + mix(np.arange(segments, dtype=np.uint64) + _U(band << 32)))
    return names[full] if full.sum() > d else names


# ------------------------------------------------------------------ inside tasks

_FEATURES = "id long, n long, hi long, lo long, s0 long, s1 long, s2 long, s3 long, wide array<bigint>"


def _features(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, rows, wide = batch.column(0), [], []
        for _, texts in blocks(batch.column(1).to_pylist()):
            for s in shingle_sets(texts, k):
                rows.append((len(s), *set_name(s), *parity_sketch(s)))
                wide.append(wide_sketch(s))
        if rows:
            columns = [pa.array(np.array(c, np.int64)) for c in zip(*rows, strict=True)]
            columns.append(pa.array(wide, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([ids, *columns], ["id", "n", "hi", "lo", "s0", "s1", "s2", "s3", "wide"])


def _segments(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    bands, seen = Bands(num, den), set()
    for batch in batches:
        for _, texts in blocks(batch.column(0).to_pylist()):
            keys, names = [], []
            for s in shingle_sets(texts, k):
                if not len(s) or (name := set_name(s)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                for band in bands.entered(len(s)):
                    found = segment_keys(s, band, *bands.segments(band))
                    keys.append(found)
                    names.append((*name, len(found)))
            if keys:
                hi, lo, count = (np.array(c, np.int64) for c in zip(*names, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(hi, count)), pa.array(np.repeat(lo, count))],
                    ["key", "hi", "lo"],
                )


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key and name: every distinct member of a bucket but its first, with the first and a rank."""
    key = first = last = None
    rank = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        k, hi, lo = (batch.column(c).to_numpy() for c in range(3))
        new_key = np.concatenate([[key is None or k[0] != key], k[1:] != k[:-1]])
        new = new_key.copy()
        new[1:] |= (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        new[0] |= last != (hi[0], lo[0])
        opens = np.flatnonzero(new_key)
        run = np.cumsum(new_key) - 1  # -1: goes on from the batch before
        nth = np.cumsum(new)
        base = np.where(run >= 0, nth[opens[run]] if len(opens) else 0, -rank)
        ranks = nth - base
        ranks[run < 0] = rank + nth[run < 0]
        h = np.where(run >= 0, hi[opens[run]] if len(opens) else 0, first[0] if first else 0)
        l = np.where(run >= 0, lo[opens[run]] if len(opens) else 0, first[1] if first else 0)  # noqa: E741
        out = new & ~new_key
        if out.any():
            columns = [k[out], h[out], l[out], hi[out], lo[out], ranks[out]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)) for c in columns], ["key", "hi_a", "lo_a", "hi_b", "lo_b", "rank"]
            )
        key, first, last, rank = k[-1], (h[-1], l[-1]), (hi[-1], lo[-1]), int(ranks[-1])


def _packed(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The class of each text and its compressed bytes."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        hi, lo, body = [], [], []
        for _, texts in blocks(batch.column(0).to_pylist()):
            for text, s in zip(texts, shingle_sets(texts, k), strict=True):
                name = set_name(s)
                hi.append(name[0])
                lo.append(name[1])
                body.append(press.compress(text))
        yield pa.RecordBatch.from_pydict(
            {"hi": pa.array(hi, pa.int64()), "lo": pa.array(lo, pa.int64()), "body": pa.array(body, pa.binary())}
        )


def _verified(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """The pairs that are linked.  Rows come sorted by ``a``, whose set is kept while it repeats."""
    unpack = zstandard.ZstdDecompressor()
    shingles = lambda body: shingle_sets([unpack.decompress(body)], k)[0]
    held: tuple = (None, None)
    for batch in batches:
        trim_memory()
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        left, right = batch.column(2), batch.column(3)
        keep = []
        for row, (x, _) in enumerate(zip(a, b, strict=True)):
            if held[0] != x:
                held = (x, shingles(left[row].as_py()))
            mine, other = held[1], shingles(right[row].as_py())
            both = len(np.intersect1d(mine, other, assume_unique=True))
            keep.append(den * both >= num * (len(mine) + len(other) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


# ------------------------------------------------------------------ the join

SKETCH = ["s0", "s1", "s2", "s3"]


def _may_link(num: int, den: int, a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """Sizes allow a link, and the sketches differ in no more bits than linked sets can."""
    apart = sum((F.bit_count(a(s).bitwiseXOR(b(s))) for s in SKETCH), F.lit(0))
    sizes = (F.least(a("n"), b("n")) * den >= F.greatest(a("n"), b("n")) * num) & (a("n") > 0)
    return sizes & (apart * (den + num) <= (a("n") + b("n")) * (den - num))


def _may_link_wide(num: int, den: int, a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """The same test on the wide sketches.  The halves of the longer one, XORed, are a sketch of the other's width."""
    one, two = a("wide"), b("wide")
    width = F.least(F.size(one), F.size(two))
    xor = lambda x, y: x.bitwiseXOR(y)
    halved = lambda s: F.zip_with(F.slice(s, 1, width), F.slice(s, width + 1, width), xor)
    folded = lambda s: F.when(F.size(s) > width, halved(s)).otherwise(s)
    bits = F.zip_with(folded(one), folded(two), lambda x, y: F.bit_count(xor(x, y)))
    apart = F.aggregate(bits, F.lit(0), lambda total, x: total + x)
    far = F.greatest(F.size(one), F.size(two)) > 2 * width  # sizes of low similarities: no test
    return far | (apart * (den + num) <= (a("n") + b("n")) * (den - num))


def with_first_keys(members: DataFrame) -> DataFrame:
    """Rows of ``key`` and ``rep`` with ``firsts``, the least keys of the row's ``rep``."""
    firsts = F.slice(F.sort_array(F.collect_set("key")), 1, FIRST_KEYS)
    return members.join(members.groupBy("rep").agg(firsts.alias("firsts")), "rep")


def meets_first(key: Column) -> Column:
    """Whether two sides have no key in common that is less than ``key``, among their least keys.

    The least key that they have in common always passes, so no pair is lost; a pair can pass more than
    once only if none of the least keys are in common.
    """
    return F.coalesce(F.array_min(F.array_intersect("firsts_a", "firsts_b")) >= key, F.lit(True))


def _named(side: str) -> Callable[[str], Column]:
    return lambda column: F.col(f"{column}_{side}")


def _neighbours(members: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of a bucket's members that are next to one another by one of the sketch's parts."""
    whole = F.struct("rep", "n", *SKETCH)
    before = []
    for k in range(len(SKETCH)):
        order = Window.partitionBy("key").orderBy(*SKETCH[k:], *SKETCH[:k], "rep")
        before.append(F.lag(whole).over(order))
    rows = members.withColumn("_before", F.array(*before))
    near = F.filter("_before", lambda p: p.isNotNull() & _may_link(num, den, p.getField, F.col))
    return rows.select(F.col("rep").alias("rep_a"), F.explode(near).alias("p")).select("rep_a", F.col("p.rep").alias("rep_b"))


def _side(classes: DataFrame, side: str) -> DataFrame:
    return classes.select(*[F.col(c).alias(f"{c}_{side}") for c in ("hi", "lo", "rep", "n", *SKETCH)])


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).where("a < b").distinct()


def _links(pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``: numbers of classes) whose texts are linked."""
    for side in "ab":
        pairs = pairs.join(classes.select(F.col("rep").alias(side), F.col("n").alias(f"n_{side}"), F.col("wide").alias(f"wide_{side}")), side)
    pairs = settled(pairs.where(_may_link_wide(num, den, _named("a"), _named("b"))).select("a", "b"), "pairs")
    wanted = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    wanted = classes.select("rep", F.col("low").alias("id")).join(wanted, "rep").select("id").distinct()
    texts = docs.join(wanted.hint("shuffle_hash"), "id", "left_semi").select("text")
    bodies = texts.mapInArrow(partial(_packed, k=k), "hi long, lo long, body binary")
    bodies = (
        bodies.join(classes.select("hi", "lo", "rep"), ["hi", "lo"])
        .groupBy("rep")
        .agg(F.first("body").alias("body"))
    )
    bodies = settled(bodies, "bodies")
    both = pairs.join(bodies.select(F.col("rep").alias("b"), F.col("body").alias("right")), "b").join(
        bodies.select(F.col("rep").alias("a"), F.col("body").alias("left")), "a"
    )
    checked = both.select("a", "b", "left", "right").mapInArrow(
        partial(_verified, k=k, num=num, den=den), "a long, b long"
    )
    return settled(checked, "verified")


def _ids_in_classes(features: DataFrame, classes: DataFrame) -> DataFrame:
    """``id`` and ``rep`` of the ids whose rows have different sets (an empty one is in no class)."""
    mixed = features.where("id is not null").groupBy("id").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("hi", "lo") for f in (F.min, F.max)])
    mixed = settled(mixed.where("min_hi < max_hi or min_lo < max_lo").select("id"), "mixed")
    sets = features.where("n > 0").join(mixed, "id", "left_semi").select("id", "hi", "lo").distinct()
    return settled(sets.join(classes.select("hi", "lo", "rep"), ["hi", "lo"]).select("id", "rep"), "mixed")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    k: int = 5,
    num: int = 4,
    den: int = 5,
) -> DataFrame:
    """One row per document: ``id``, ``n_shingles`` and ``component`` (smallest id reachable by links).

    Two documents are linked if the Jaccard similarity of their sets of ``k``-word shingles is
    ``num / den`` or more.  A null or empty text, or one of blanks, has an empty set and is linked with
    nothing.  Rows with one id are one node, with the links of all its texts; a row without an id is returned with component null and
    links with nothing.  Repeated rows are returned as often as they come; other columns don't matter;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    features = settled(docs.mapInArrow(partial(_features, k=k), _FEATURES), "features")
    docs = docs.where("id is not null")
    classes = (
        features.where("n > 0 and id is not null")
        .groupBy("hi", "lo")
        .agg(F.min("id").alias("low"), *[F.first(c).alias(c) for c in ("n", *SKETCH, "wide")])
    )
    classes = settled(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    ids_in = _ids_in_classes(features, classes)
    shared = ids_in.join(ids_in.groupBy("id").agg(F.min("rep").alias("a")), "id").select("a", F.col("rep").alias("b"))
    entries = docs.select("text").mapInArrow(partial(_segments, k=k, num=num, den=den), "key long, hi long, lo long")
    stars = (
        entries.repartition(shuffle_partitions(spark), "key")
        .sortWithinPartitions("key", "hi", "lo")
        .mapInArrow(_stars, "key long, hi_a long, lo_a long, hi_b long, lo_b long, rank long")
    )
    named = stars.join(_side(classes, "a"), ["hi_a", "lo_a"]).join(_side(classes, "b"), ["hi_b", "lo_b"])
    named = settled(named.drop("hi_a", "lo_a", "hi_b", "lo_b"), "stars")
    larger = named.where("rank >= 2").select("key").distinct()
    sides = [F.struct(*[F.col(f"{c}_{s}").alias(c) for c in ("rep", "n", *SKETCH)]) for s in ("a", "b")]
    members = named.join(larger, "key", "left_semi").select("key", F.explode(F.array(*sides)).alias("m"))
    members = settled(members.select("key", "m.*").distinct(), "members")
    with_first = named.where(_may_link(num, den, _named("a"), _named("b"))).select("rep_a", "rep_b")
    first_pairs = settled(_ordered(with_first), "pairs").union(settled(_ordered(_neighbours(members, num, den)), "pairs"))
    first_pairs = settled(first_pairs.distinct(), "pairs")
    links = _links(first_pairs, docs, classes, k, num, den)

    # what is still apart within a bucket is compared pair by pair
    grouped = components(links.union(shared))
    labels = grouped.select(F.col("id").alias("rep"), "component")
    members = members.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    parted = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    members = members.join(parted.where("low < high").select("key"), "key", "left_semi")
    members = settled(with_first_keys(members).join(classes.select("rep", "wide"), "rep"), "apart")
    one, two = (
        members.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("rep", "n", "component", *SKETCH, "wide", "firsts")]) for s in ("a", "b")
    )
    apart = (one["key"] == two["key"]) & (F.col("component_a") < F.col("component_b"))
    sides = (num, den, _named("a"), _named("b"))
    rest = one.join(two, apart & _may_link(*sides) & _may_link_wide(*sides) & meets_first(one["key"]))
    rest = _ordered(rest).join(first_pairs, ["a", "b"], "left_anti")
    more = _links(rest, docs, classes, k, num, den)
    labels = joined_components(grouped, more).withColumnRenamed("id", "rep")
    least = classes.join(labels, "rep").groupBy("component").agg(F.min("low").alias("least"))
    labels = labels.join(least, "component").select("rep", F.col("least").alias("component"))
    named = classes.select("hi", "lo", "rep", "low").join(labels, "rep", "left")
    named = named.select("hi", "lo", "rep", F.coalesce("component", "low").alias("component"))
    # rows whose own set is empty, though their id has others
    by_id = ids_in.join(named, "rep").groupBy("id").agg(F.min("component").alias("of_id"))
    found = features.join(named, ["hi", "lo"], "left").join(settled(by_id, "by-id"), "id", "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component", "of_id", "id"))
    return found.select("id", F.col("n").alias("n_shingles"), own.alias("component"))
