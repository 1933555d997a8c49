"""Chosen-path join, lexical search and fill-in-the-middle against brute force, on all the odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from functools import partial

import numpy as np
import pytest

from landflow.llm import accumulators, chosen_path, rotation
from landflow.llm.queries import BUILDS
from tests.llm.conftest import answers, in_order
from tests.llm.test_similarity import brute_components


@pytest.mark.parametrize(("k", "num", "den"), [(4, 4, 5), (2, 1, 2)])
def test_components_equal_brute_force(documents, rows, k, num, den):
    found = chosen_path.near_duplicates(documents, k=k, num=num, den=den)
    assert answers(found, "id", "n_shingles", "component") == in_order(brute_components(rows, k, num, den))


def test_parities_refuse_near_copies_before_their_texts(spark):
    """op11_chosen_path: pairs of similarity 0.74 pass the sketch of the signature, and had their texts compared."""
    dice, words = random.Random(3), [f"w{n}" for n in range(80)]

    def copies(changes):
        for n in range(40):
            text = list(words)
            for at in dice.sample(range(0, 80, 2), changes):
                text[at] = f"x{n}y{at}"
            yield n, " ".join(text)

    def passing(changes):
        rows = spark.createDataFrame(list(copies(changes)), "doc_id long, text string").mapInArrow(partial(chosen_path._features, k=2), chosen_path._FEATURES)
        rows = rows.withColumnRenamed("id", "rep").cache()
        one, two = (chosen_path._side(rows, side) for side in "ab")
        return one.join(two, chosen_path._may_link(4, 5) & (one["rep_a"] < two["rep_b"])).count()

    assert passing(3) < 80 < 700 < passing(1) == 780


def test_whole_table_equals_brute_force(spark, sf_dir):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = answers(BUILDS["op11_chosen_path"](spark, sf_dir), "doc_id", "n_shingles", "component_id", "kept")
    assert found == in_order((i, n, c, i == c) for i, n, c in brute_components(texts, 4, 4, 5))


def test_large_group_of_near_copies_with_outsiders(spark):
    """Nodes that are not small branch; a chain and a star of near copies are one component each."""
    draw = np.random.default_rng(3)
    base = [f"w{x}" for x in draw.integers(0, 10**6, 100)]
    docs = []
    for k in range(150):  # all linked to the first, hardly to one another
        words = base.copy()
        for at in draw.choice(100, 2 if k else 0, replace=False):
            words[at] = f"s{k}"
        docs.append((k, " ".join(words)))
    for k in range(150, 300):  # half of the words are shared, which links nothing
        docs.append((k, " ".join(base[:50] + [f"u{k}.{x}" for x in range(50)])))
    found = chosen_path.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=2)
    assert answers(found, "id", "n_shingles", "component") == in_order(brute_components(docs, 2, 4, 5))


def test_texts_of_a_large_hub_go_out_in_pieces(spark, documents, rows, monkeypatch):
    monkeypatch.setattr(chosen_path, "PIECE", 2)
    found = chosen_path.near_duplicates(documents, k=4, num=4, den=5)
    assert answers(found, "id", "n_shingles", "component") == in_order(brute_components(rows, 4, 4, 5))
    same = " ".join(f"w{x}" for x in range(60))
    docs = [(n, f"{same} end{n}") for n in range(40)] + [(99, "unlike all the others, by far")]
    found = chosen_path.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=4, num=4, den=5)
    assert {r["id"]: r["component"] for r in found.collect()} == {n: 0 for n in range(40)} | {99: 99}


def test_trees_follow_the_recall():
    assert chosen_path.trees_for(0.9, 4, 5) < chosen_path.trees_for(0.999, 4, 5) < chosen_path.trees_for(0.99999, 4, 5)


def test_sketches_estimate_similarity():
    draw = np.random.default_rng(1)
    pool = draw.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(pool[:1000]), np.unique(pool[200:1200])  # similarity 800 / 1200
    tokens = chosen_path.signatures([a, b])
    assert abs((tokens[0] == tokens[1]).mean() - 2 / 3) < 0.15
    packed = chosen_path.sketches(tokens)
    assert packed.shape == (2, chosen_path.WORDS)


# ------------------------------------------------------------------ search

TERM = re.compile(accumulators.TERM)


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    found = []
    for item, text in items:
        scored = []
        for at, (doc, c) in enumerate(counted):
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // length
            score = 0
            for t in set(terms(text)):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc, at))
        scored.sort()
        found += [(item, rank, doc, -score) for rank, (score, _, doc, _) in enumerate(scored[:k], 1)]
    return found


@pytest.mark.parametrize("k", [1, 3, 50])
def test_search_equals_brute_force(spark, documents, rows, k):
    items = [(1, rows[62][1]), (2, "the STONE river 42"), (3, None), (4, ""), (5, "nowhere"), (6, rows[95][1]), (None, "run ran"), (2, "日本語 Élan it's"), (7, rows[138][1])]
    asked = spark.createDataFrame([(*r, 0, 0) for r in items], "item_id long, text string, doc long, rank int")
    found = accumulators.rank_documents(documents, asked, k)
    assert answers(found, "item_id", "rank", "score") == in_order((i, r, s) for i, r, _, s in brute_search(rows, items, k))
    ids = [r for r in answers(found, "item_id", "rank", "doc_id", "score") if r[0] not in (None, 2)]
    assert ids == in_order(r for r in brute_search(rows, items, k) if r[0] not in (None, 2))


def test_search_without_documents_or_items(documents, no_documents):
    asked = documents.selectExpr("doc_id AS item_id", "text")
    assert accumulators.rank_documents(no_documents, asked).count() == 0
    assert accumulators.rank_documents(documents, asked.where("false")).count() == 0


# ------------------------------------------------------------------ fill in the middle


def brute_middle(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_middle_equals_brute_force(documents, rows):
    found = rotation.fill_in_middle(documents, check=True)
    want = [(i, *brute_middle(i, t), t or "") for i, t in rows]
    assert answers(found, "id", "n", "form", "prefix_chars", "middle_chars", "output", "restored") == in_order(want)
    assert {r[2] for r in want} == {"plain", "psm", "spm"}


def test_middle_of_texts_with_marks_and_odd_signs(spark):
    texts = ["<P", "a<S>b", "<<P>>", "<M", "P>", "S>x<", "é<é", "\x00", "\r\n", "😀a😀", "ß" * 50, "<P" * 9, "abc"]
    docs = [(100 * k + j, t) for k, t in enumerate(texts) for j in range(8)]
    found = rotation.fill_in_middle(spark.createDataFrame(docs, "doc_id long, text string"))
    want = [(i, *brute_middle(i, t)) for i, t in docs]
    assert answers(found, "id", "n", "form", "prefix_chars", "middle_chars", "output") == in_order(want)
    back = rotation.restored_text(found.drop("restored"))
    assert answers(back, "id", "restored") == in_order(docs)


def test_exchange_is_its_own_inverse_with_sides_swapped():
    for left, between, right in ((0, 0, 5), (0, 5, 5), (1, 2, 5), (0, 3, 5)):
        buffer = bytearray(b"abcde")
        rotation.exchange(buffer, left, between, right)
        assert bytes(buffer) == b"abcde"[:left] + b"abcde"[between:right] + b"abcde"[left:between] + b"abcde"[right:]
        rotation.exchange(buffer, left, left + right - between, right)
        assert bytes(buffer) == b"abcde"


def test_no_documents_no_rows(no_documents):
    assert rotation.fill_in_middle(no_documents).count() == 0
    assert chosen_path.near_duplicates(no_documents).count() == 0
