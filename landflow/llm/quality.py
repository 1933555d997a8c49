"""Document quality by Bradley-Terry ranking.

Preference pairs of a good and a poor document say which should score higher; weights are learnt by
logistic loss on the differences of their features.  The score is a ranking, so the line between
keeping and rejecting is drawn afterwards, at the quantile of the learning documents' scores that
equals their share of poor ones.  Features come from the whole text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landflow.llm.common import text_of
from landflow.llm.hashing import trim_memory

#: Labelled documents that the fit uses at most (those with the smallest hash of their id).
SAMPLE = 20_000
#: Preference pairs drawn from them.
PAIRS = 60_000
SEED = 7

#: Characters whose share of a text is a feature of its own.
MARKS = "!#$%&*|@<>{}[]=_~^\\/+;:()\"'.,?-"


def _byte_classes() -> np.ndarray:
    table = np.zeros((256, len(MARKS) + 6))
    for k, mark in enumerate(MARKS):
        table[ord(mark), k] = 1
    for k, (low, high) in enumerate((("A", "Z"), ("a", "z"), ("0", "9")), len(MARKS)):
        table[ord(low) : ord(high) + 1, k] = 1
    table[0x20, len(MARKS) + 3] = 1
    table[0x0A, len(MARKS) + 4] = 1
    table[0x80:, len(MARKS) + 5] = 1
    return table


_CLASSES = _byte_classes()


def features(text: str) -> np.ndarray:
    """Numbers that describe a text: shares of marks and letters, repetition, lengths."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    shares = (np.bincount(data, minlength=256) @ _CLASSES) / (len(data) + 20)  # few bytes say little
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    upper = sum(map(str.isupper, words)) / (n + 4)
    again = sum(map(eq, words, islice(words, 1, None))) / (n + 4)
    more = [
        upper,
        again,
        len(set(words)) / n,
        len(set(lines)) / len(lines),
        min(len(text) / n, 100) / 100,
        np.log1p(len(words)) / 10,
        np.log1p(len(text) / len(lines)) / 10,
    ]
    return np.concatenate([shares, np.log1p(50 * shares), more, [np.log1p(50 * upper), np.log1p(50 * again)]])


WIDTH = len(features(""))


@dataclass(frozen=True)
class Ranker:
    weights: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    threshold: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; 0.5 is the threshold."""
        z = (rows - self.mean) / self.spread @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_pairs(better: np.ndarray, worse: np.ndarray, penalty: float = 1e-3, rounds: int = 25) -> np.ndarray:
    """Weights of least mean logistic loss on ``better - worse``, by Newton's method."""
    d = better - worse
    w = np.zeros(d.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(d @ w, -35, 35)))
        slope = d.T @ p / len(d) - penalty * w
        bend = (d * (p * (1 - p))[:, None]).T @ d / len(d) + penalty * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_rows(rows: np.ndarray, label: np.ndarray, pairs: int = PAIRS, seed: int = SEED) -> Ranker:
    """A ranker from features and labels (1 good, 0 poor); without both labels every score is 0.5."""
    good, poor = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(poor):
        return Ranker(np.zeros(WIDTH), np.zeros(WIDTH), np.ones(WIDTH), 0.0)
    mean, spread = rows.mean(0), rows.std(0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    x = (rows - mean) / spread
    draw = np.random.default_rng(seed)
    w = fit_pairs(x[draw.choice(good, pairs)], x[draw.choice(poor, pairs)])
    return Ranker(w, mean, spread, float(np.quantile(x @ w, len(poor) / len(label))))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
    pairs: int = PAIRS,
) -> Ranker:
    """Learns from the labelled rows of ``docs``, at most ``sample`` of them (a documented bound).

    Labels other than 0 and 1 and null ids are left out; of contradicting labels the lower counts.  An
    id that several rows have teaches with one of its texts, the one whose hash is least.
    """
    known = (
        labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label}`").alias("label"))
        .where("label in (0, 1) and id is not null")
        .groupBy("id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
    )
    body = docs.select(F.col(f"`{id_column}`").alias("id"), text_of(text).alias("text"))
    chosen = body.join(F.broadcast(known), "id")  # at most ``sample`` ids
    one = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    chosen = chosen.groupBy("id", "label").agg(one)
    rows = chosen.select("id", "label", _features_of("text").alias("x")).orderBy("id", "label").collect()
    if not rows:
        return fit_rows(np.zeros((0, WIDTH)), np.zeros(0))
    return fit_rows(np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows]), pairs)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _features_of(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: features(t).tolist())


def with_score(docs: DataFrame, ranker: Ranker, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with a quality score of each whole text between 0 and 1 (0.5: the threshold).

    Null and empty texts get the score of an empty text.  Rows come back as they are, repeated ones
    too; other columns don't matter (one named like ``into`` is replaced); an empty table stays empty.
    """

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            trim_memory()
            rows = np.array([features(t) for t in batch]).reshape(len(batch), WIDTH)
            yield pd.Series(ranker.scores(rows), dtype="float64")

    return docs.withColumn(into, score(text_of(text)))
