from __future__ import annotations

import random

import pytest

#: Extra columns whose names the operators use themselves.
CLASHING = ["id", "n", "size", "key", "component", "ids", "score", "n_tokens", "shard", "epochs", "digest", "k1", "rep"]


def make_documents(seed: int = 5) -> list[tuple]:
    """Documents with copies, near copies, shared passages, and all the odd cases."""
    draw = random.Random(seed)
    words = ["the", "of", "a", "Stone", "river,", "élan", "naïve.", "42", "über", "it's", "x" * 30, "日本語", "run", "ran"]
    text = lambda n: " ".join(draw.choice(words) for _ in range(n)) + draw.choice(["", ".", "\n", "  \t"])
    passage = " ".join(f"word{k}" for k in range(60))
    rows = []
    for k in range(60):
        rows.append((k, text(draw.choice([0, 1, 2, 3, 12, 60, 150]))))
    base = [f"tok{draw.randrange(10_000)}" for _ in range(120)]
    for k in range(60, 90):  # near copies, one after the other further apart
        if draw.random() < 0.7:
            base = base.copy()
            base[draw.randrange(120)] = f"new{k}"
        rows.append((k, " ".join(base)))
    for k in range(90, 100):
        rows.append((k, text(10) + passage + text(10)))
    rows += [(k, rows[62][1]) for k in range(100, 130)]  # a large group of copies
    rows += [(130, None), (131, ""), (132, " \n\t "), (133, None), (134, "")]
    rows += [(135, "ab" * 20_000), (136, "a" * 5000), (137, (passage + " ") * 30), (138, text(20_000))]
    rows += [(139, "a<|endoftext|>b c<|startoftext|>"), (140, "x  y  z  \x1c! Å"), (141, "ΣΑΣ İstanbul ﬁn")]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (None, "no id"), (None, None), (None, rows[61][1])]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_documents()


@pytest.fixture(scope="session")
def documents(spark, rows):
    """The documents with columns of clashing names, in several partitions."""
    full = [(i, t, "en" if (i or 0) % 3 else None, f"src{(i or 0) % 4}", *range(len(CLASHING))) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} int" for c in CLASHING)
    return spark.createDataFrame(full, schema).repartition(5)


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.where("false")


def answers(df, *columns):
    """Rows as a sorted list of tuples, nulls first."""
    return in_order(tuple(r) for r in df.select(*columns).collect())


def in_order(rows):
    return sorted(rows, key=lambda r: [(v is not None, str(type(v)), v) if v is not None else (False,) for v in r])
