from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from landflow.llm import parity_join, prefix_free
from landflow.llm.components import components, joined_components
from tests.llm.conftest import answers, in_order

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def shingles(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[j : j + k]) for j in range(len(words) - k + 1))


def brute_components(rows, k, num, den):
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(i, s) for i, s in sets if i is not None and s]
    for n, (i, s) in enumerate(known):
        for j, t in known[:n]:
            if den * len(s & t) >= num * len(s | t):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [(i, len(s), None if i is None else root(i)) for i, s in sets]


@pytest.mark.parametrize(("k", "num", "den"), [(3, 9, 10), (5, 4, 5), (1, 1, 2)])
def test_components_equal_brute_force(documents, rows, k, num, den):
    found = parity_join.near_duplicates(documents, k=k, num=num, den=den)
    assert answers(found, "id", "n_shingles", "component") == in_order(brute_components(rows, k, num, den))


def test_chains_within_one_bucket_are_found(spark):
    """Each text is linked with its neighbours only; some are linked with no bucket's first member."""
    words = [f"w{k}" for k in range(300)]
    rows = []
    for n in range(40):
        rows.append((100 - n, " ".join(words)))
        for j in range(6):
            words[(n * 6 + j) % 300] = f"v{n}_{j}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = parity_join.near_duplicates(docs, k=1, num=9, den=10)
    assert answers(found, "id", "n_shingles", "component") == in_order(brute_components(rows, 1, 9, 10))


def test_an_id_with_several_texts_has_the_links_of_all(spark):
    text = lambda name, new="": " ".join([*(f"{name}{k}" for k in range(60)), new])
    rows = [(5, text("a")), (5, text("b")), (9, text("a", "x")), (10, text("b", "x")), (9, None)]
    rows += [(20, text("c")), (21, text("c")), (21, text("d")), (22, text("d", "x")), (22, ""), (30, text("e")), (30, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = parity_join.near_duplicates(docs, k=3, num=9, den=10)
    want = brute_components(rows, 3, 9, 10)
    assert {(i, c) for i, _, c in want} == {(5, 5), (9, 5), (10, 5), (20, 20), (21, 20), (22, 20), (30, 30)}
    assert answers(found, "id", "n_shingles", "component") == in_order(want)


def test_sketches_bound_the_difference():
    draw = np.random.default_rng(3)
    for _ in range(200):
        both = draw.integers(0, 1 << 63, 40).astype(np.uint64)
        a, b = np.unique(both[: draw.integers(1, 40)]), np.unique(both[draw.integers(0, 39) :])
        apart = sum(bin((x ^ y) & ((1 << 64) - 1)).count("1") for x, y in zip(parity_join.parity_sketch(a), parity_join.parity_sketch(b), strict=True))
        assert apart <= len(set(a.tolist()) ^ set(b.tolist()))


def test_wide_sketches_of_unlike_widths_bound_the_difference(spark):
    """Sets around a change of width: the folded distance never exceeds the difference, so no link is lost."""
    draw, rows = np.random.default_rng(7), []
    for size in (200, 250, 260, 500, 515, 1000, 1030, 2050):
        for part in (0.8, 0.9, 1.0):
            pool = np.unique(draw.integers(0, 1 << 63, 2 * size).astype(np.uint64))
            draw.shuffle(pool)
            a, b = pool[:size], pool[size - int(size * part) : size + 9]
            rows.append((parity_join.wide_sketch(a), parity_join.wide_sketch(b), len(a), len(b), len(set(a.tolist()) ^ set(b.tolist()))))
    df = spark.createDataFrame(rows, "wide_a array<long>, wide_b array<long>, n_a long, n_b long, differ long")
    for num, den in ((9, 10), (4, 5), (1, 2)):
        passed = parity_join._may_link_wide(num, den, parity_join._named("a"), parity_join._named("b"))
        linked = F.col("differ") * (den + num) <= (F.col("n_a") + F.col("n_b")) * (den - num)
        assert df.where(linked & ~passed).count() == 0
        assert num * 2 == den or df.where(linked).count() > 0


def test_a_pair_is_made_in_its_first_bucket_only(spark):
    """Near copies meet in most of their buckets: made in each of them, a pair was a row 40 times."""
    draw = np.random.default_rng(3)
    keys = {rep: set(draw.integers(-(1 << 62), 1 << 62, 100).tolist()) for rep in range(12)}
    common = draw.integers(-(1 << 62), 1 << 62, 90).tolist()
    for rep in range(8):
        keys[rep] |= set(common[rep * 5 :])
    keys[11] |= {max(keys[10])}  # one key in common, and not among the least
    rows = [(key, rep) for rep, of in keys.items() for key in of]
    members = parity_join.with_first_keys(spark.createDataFrame(rows, "key long, rep long"))
    one, two = (members.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("rep", "firsts")]) for s in "ab")
    met = one.join(two, (one["key"] == two["key"]) & (F.col("rep_a") < F.col("rep_b")) & parity_join.meets_first(one["key"]))
    found = sorted(tuple(r) for r in met.select("rep_a", "rep_b").collect())
    assert found == sorted([(a, b) for a in range(8) for b in range(a + 1, 8)] + [(10, 11)])


@pytest.mark.parametrize("half", [150, 900])
def test_unlike_documents_with_one_shared_passage_are_hardly_compared(spark, monkeypatch, half):
    """400 documents share half of their words and have no link: far fewer than all 79,800 pairs reach the texts."""
    passage = " ".join(f"p{k}" for k in range(half))
    rows = [(i, f"{passage} " + " ".join(f"d{i}.{k}" for k in range(half))) for i in range(400)]
    pairs, packed = [], parity_join._verified

    def counted(name):
        def settle(df, label):
            found = parity_join_settled(df, label)
            if label == name:
                pairs.append(found.count())
            return found

        return settle

    parity_join_settled = parity_join.settled
    monkeypatch.setattr(parity_join, "settled", counted("pairs"))
    found = parity_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=5, num=4, den=5)
    assert found.where("component <> id").count() == 0
    assert pairs[-1] < 800 and packed is parity_join._verified


@pytest.mark.parametrize(("num", "den"), [(9, 10), (4, 5), (1, 2)])
def test_linked_sets_share_a_segment(num, den):
    """Pigeonhole: over all sizes, sets at the edge of the similarity agree in a segment of a common band."""
    draw, bands = np.random.default_rng(1), parity_join.Bands(num, den)
    for size in [*range(1, 80), 200, 500]:
        for other in {size, bands.largest_partner(size), (size + bands.largest_partner(size)) // 2}:
            most = bands.differences(size, other)
            common = (size + other - most + 1) // 2
            pool = np.unique(draw.integers(0, 1 << 63, 3 * (size + other)).astype(np.uint64))
            draw.shuffle(pool)
            a = np.sort(np.concatenate([pool[:common], pool[common:size]]))
            b = np.sort(np.concatenate([pool[:common], pool[size : size + other - common]]))
            inter = len(np.intersect1d(a, b))
            if den * inter < num * (len(a) + len(b) - inter) or np.array_equal(a, b):
                continue
            keys = [
                {(band, x) for band in bands.entered(len(s)) for x in parity_join.segment_keys(s, band, *bands.segments(band)).tolist()}
                for s in (a, b)
            ]
            assert keys[0] & keys[1], (size, other)


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 130)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert answers(found, "id", "component") == [(k, 0) for k in range(51)] + [(k, 100) for k in range(100, 130)]
    more = spark.createDataFrame([(50, 101), (200, 201), (202, 129)], "a long, b long")
    both = joined_components(found, more)
    want = [*range(51), *range(100, 130), 202]
    assert answers(both, "id", "component") == in_order([(k, 0) for k in want] + [(k, 200) for k in (200, 201)])
    assert components(found.select(F.col("id").alias("a"), F.col("id").alias("b")).where("a < 0")).collect() == []


def test_components_of_random_graphs(spark):
    draw = np.random.default_rng(9)
    links = draw.integers(0, 400, (380, 2)).tolist()
    parent = list(range(400))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    nodes = {x for a, b in links if a != b for x in (a, b)}
    df = spark.createDataFrame(links, "a long, b long")
    assert answers(components(df), "id", "component") == in_order((x, root(x)) for x in nodes)
    half = joined_components(components(df.limit(190)), df)
    assert answers(half, "id", "component") == in_order((x, root(x)) for x in nodes)


def brute_removal(rows, width):
    seen, out = {}, []
    for i, t in rows:
        if i is not None:
            data = (t or "").encode()
            for s in range(len(data) - width + 1):
                seen.setdefault(data[s : s + width], (i, s))
                seen[data[s : s + width]] = min(seen[data[s : s + width]], (i, s))
    for i, t in rows:
        data, gone = (t or "").encode(), set()
        for s in range(len(data) - width + 1):
            if i is not None and seen[data[s : s + width]] < (i, s):
                gone.update(range(s, s + width))
        out.append((i, len(data), bytes(c for k, c in enumerate(data) if k not in gone)))
    return out


@pytest.mark.parametrize(("width", "gram"), [(100, 32), (40, 8)])
def test_removal_equals_brute_force(documents, rows, width, gram):
    found = prefix_free.remove_repeats(documents, width=width, gram=gram)
    assert answers(found.select("id", "n_bytes", F.hex("kept").alias("kept")), "id", "n_bytes", "kept") == in_order(
        (i, n, kept.hex().upper()) for i, n, kept in brute_removal(rows, width)
    )
    for r in found.collect():
        assert r["n_bytes"] - len(r["kept"]) == sum(s["end"] - s["start"] for s in r["spans"])
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_long_texts_are_cut_into_pieces(monkeypatch):
    text = bytes(np.random.default_rng(2).integers(97, 100, 3000).astype(np.uint8))
    pieces = prefix_free._pieces(text, 100)
    monkeypatch.setattr(prefix_free, "PIECE", 500)
    assert prefix_free._pieces(text, 100) != pieces
    windows = defaultdict(int)
    for shift, piece in prefix_free._pieces(text, 100):
        _, start, shape, *_ = prefix_free.phrases([piece], 100, 32)
        for s, n in zip(start + shift, shape & 4095, strict=True):
            for w in range(s, s + n):
                windows[w] += 1
    assert windows == {w: 1 for w in range(2901)}


def test_no_rows(no_documents):
    assert parity_join.near_duplicates(no_documents).collect() == []
    assert prefix_free.remove_repeats(no_documents).collect() == []
