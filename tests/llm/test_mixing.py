from __future__ import annotations

import hashlib
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from landflow.llm import mixing
from tests.llm.conftest import answers, in_order

WEIGHTS = ({"a": 3, "b": 1}, {"en": 2}, {"src0": 5, "src3": 2})
DOMAIN = "CASE source WHEN 'src3' THEN 'b' WHEN 'src2' THEN NULL ELSE 'a' END"


def filled(budget, children, weights):
    """Grants by rounds: who can't use its share takes its supply, the others share the rest."""
    grants, open_ = {}, dict(children)
    while open_:
        total = sum(weights[c] for c in open_)
        full = [c for c, supply in open_.items() if Fraction(weights[c] * budget, total) >= supply]
        if not full:
            return grants | {c: weights[c] * budget // total for c in open_}
        for c in full:
            grants[c] = open_.pop(c)
            budget -= grants[c]
    return grants


def brute(rows, mix):
    docs = []
    for i, t in rows:
        source = f"src{(i or 0) % 4}"
        domain = {"src3": "b", "src2": ""}.get(source, "a")
        words = [w for w in (t or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
        docs.append((i, (domain, "en" if (i or 0) % 3 else "", source), len(words)))
    tokens = defaultdict(int)
    for _, leaf, n in docs:
        tokens[leaf] += n
    supply = lambda path: sum(n * mix.epochs for leaf, n in tokens.items() if leaf[: len(path)] == path)
    grants = {(): min(sum(tokens.values()) * mix.num // mix.den, supply(()))}
    for depth, weights in enumerate(mix.weights):
        nxt = {}
        for path, budget in grants.items():
            children = {leaf[: depth + 1] for leaf in tokens if leaf[:depth] == path}
            nxt |= filled(budget, {c: supply(c) for c in children}, {c: weights.get(c[-1], mix.default) for c in children})
        grants = nxt
    out = []
    for i, leaf, n in docs:
        whole = grants[leaf] // tokens[leaf] if tokens[leaf] else 0
        key = lambda x, w=whole: hashlib.md5(f"{mix.seed}|{w + 1}|{'null' if x is None else x}".encode()).hexdigest()
        upto = sum(m for j, other, m in docs if other == leaf and key(j) <= key(i))
        out.append((i, whole + (whole < mix.epochs and upto <= grants[leaf] - whole * tokens[leaf])))
    return in_order(out)


@pytest.mark.parametrize("mix", [mixing.Mix(WEIGHTS, 1, 2, 4), mixing.Mix(WEIGHTS, 4, 5, 1), mixing.Mix(num=3, den=1, epochs=2), mixing.Mix(WEIGHTS, 0, 1)])
def test_epochs_equal_brute_force(documents, rows, mix):
    found = mixing.with_epochs(documents, mix, F.expr(DOMAIN))
    assert set(found.columns) == set(documents.columns)
    assert answers(found, "doc_id", "epochs") == brute(rows, mix)


def test_a_shortage_goes_to_siblings_before_ancestors(spark):
    """One source of "a"/"en" is short; its language's other source makes up for it, nobody else."""
    rows = [("a", "en", "s1", 10), ("a", "en", "s2", 1000), ("a", "de", "s3", 1000), ("b", "en", "s4", 1000)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long")
    granted = {r["source"]: r["granted"] for r in mixing.leaf_grants(leaves, mixing.Mix(num=800, den=3010)).collect()}
    assert granted == {"s1": 10, "s2": 190, "s3": 200, "s4": 400}
    short = spark.createDataFrame([("a", "en", "s1", 10), ("a", "de", "s3", 1000), ("b", "en", "s4", 1000)], leaves.schema)
    granted = {r["source"]: r["granted"] for r in mixing.leaf_grants(short, mixing.Mix(num=800, den=2010)).collect()}
    assert granted == {"s1": 10, "s3": 390, "s4": 400}


@pytest.mark.parametrize("epochs", [1, 3])
def test_no_document_exceeds_the_epochs(documents, epochs):
    """Every leaf is used up; texts without tokens get no epoch of their own."""
    found = mixing.with_epochs(documents, mixing.Mix(num=9, den=1, epochs=epochs), F.expr(DOMAIN))
    assert {r["epochs"] for r in found.select("epochs").distinct().collect()} <= {0, epochs}


def test_rows_are_repeated(documents):
    mixed = mixing.with_epochs(documents, mixing.Mix(num=3, den=1, epochs=3), F.expr(DOMAIN), into="times")
    out = mixing.repeated(mixed, "times")
    assert out.columns == documents.columns
    assert out.count() == mixed.agg(F.sum("times")).first()[0]


def test_no_rows(no_documents):
    assert mixing.with_epochs(no_documents, mixing.Mix(), F.expr(DOMAIN)).collect() == []
