"""Token counts by two tiers of lookup, on the map side.

A *pre-token* here is a run of text between ASCII white space.  For a tokenizer that drops white
space, the number of tokens of a text is the sum over its pre-tokens, so each distinct one needs
encoding once.  Tier one is a compact table of the corpus's frequent pre-tokens and their lengths,
broadcast to all workers; tier two is a cache in each worker, filled by encoding what the table
misses.  Pre-tokens are never shuffled: the frequent ones are found by bounded summaries, one per
partition, merged ``FAN_IN`` at a time.  The table only saves time; counts don't depend on it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landflow.llm.common import text_of

#: Entries of the broadcast table: about 2 MB, whatever the size of the corpus.
FREQUENT = 1 << 17
#: Entries that a worker holds at most, table included; the cache starts again beyond it.
HELD = 700_000
#: A partition's summary counts this many pre-tokens at most before it drops the rarer half.
COUNTED = 1 << 19
#: Summaries merged in one task.
FAN_IN = 32
#: Longer pre-tokens are encoded but not kept.
KEPT_CHARS = 128


class Frequent(NamedTuple):
    """Frequent pre-tokens joined by line feeds (they hold none), and the tokens of each."""

    words: str
    lengths: bytes


def pretokens(text: str) -> list[str]:
    """Runs between ASCII white space, and an empty string for each extra space."""
    for c in "\n\t\r":
        if c in text:
            text = text.replace(c, " ")
    return text.split(" ")


def _top(counts: Counter, n: int) -> Counter:
    return Counter(dict(counts.most_common(n)))


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(pretokens(text))
            if len(counts) > COUNTED:
                counts = _top(counts, COUNTED // 2)
    counts.pop("", None)
    yield _packed(counts)


def _packed(counts: Counter) -> pa.RecordBatch:
    best = [(w, n) for w, n in counts.most_common(FREQUENT) if len(w) <= KEPT_CHARS]
    words = "\n".join(w for w, _ in best)
    numbers = np.array([n for _, n in best], dtype="<i8").tobytes()
    return pa.RecordBatch.from_pydict({"words": [words], "counts": [numbers]})


def _merged(frame: pd.DataFrame) -> pd.DataFrame:
    total: Counter = Counter()
    for words, numbers in zip(frame["words"], frame["counts"], strict=True):
        if words:
            total.update(dict(zip(words.split("\n"), np.frombuffer(numbers, "<i8").tolist(), strict=True)))
    packed = _packed(total).to_pydict()
    return pd.DataFrame({"slot": [int(frame["slot"].iloc[0])], **packed})


def frequent_pretokens(texts: DataFrame, tokenizer_path: str) -> Frequent:
    """The table for ``texts`` (one string column), from all of its rows.

    Every partition sends one summary of at most ``FREQUENT`` entries; they meet in rounds of
    ``FAN_IN``, so no task and not the driver holds more than that many of them.
    """
    summaries = texts.mapInArrow(_summary, "words string, counts binary")
    summaries = summaries.select(F.spark_partition_id().alias("slot"), "words", "counts")
    left = texts.rdd.getNumPartitions()
    while left > 1:
        summaries = summaries.withColumn("slot", F.floor(F.col("slot") / FAN_IN).cast("int"))
        summaries = summaries.groupBy("slot").applyInPandas(_merged, "slot int, words string, counts binary")
        left = -(-left // FAN_IN)
    row = summaries.select("words").first()
    words = row["words"] if row else ""
    return Frequent(words, _lengths(words.split("\n") if words else [], tokenizer_path))


_TOKENIZERS: dict[str, object] = {}


def tokenizer(path: str):
    """The library's tokenizer of a file: one for each worker, without truncation or padding."""
    if path not in _TOKENIZERS:
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        found = Tokenizer.from_file(path)
        found.no_truncation()
        found.no_padding()
        _TOKENIZERS[path] = found
    return _TOKENIZERS[path]


def _lengths(words: list[str], tokenizer_path: str) -> bytes:
    found = tokenizer(tokenizer_path).encode_batch_fast(words, add_special_tokens=False)
    return np.array([len(e) for e in found], dtype="<u4").tobytes()


class Counts:
    """Both tiers, in one dictionary per worker."""

    def __init__(self, frequent: Frequent, tokenizer_path: str):
        words = frequent.words.split("\n") if frequent.words else []
        self.table = dict(zip(words, np.frombuffer(frequent.lengths, "<u4").tolist(), strict=True))
        self.table[""] = 0
        self.held = dict(self.table)
        self.path = tokenizer_path

    def count(self, text: str) -> int:
        words = pretokens(text)
        try:
            return sum(map(self.held.__getitem__, words))
        except KeyError:
            pass
        missing = list(set(words).difference(self.held))
        if len(self.held) + len(missing) > HELD:
            self.held = dict(self.table)
            missing = list(set(words).difference(self.held))
        found = tokenizer(self.path).encode_batch_fast(missing, add_special_tokens=False)
        self.held.update(zip(missing, map(len, found), strict=True))
        total = sum(map(self.held.__getitem__, words))
        for word in missing:
            if len(word) > KEPT_CHARS:
                del self.held[word]
        return total


_COUNTS: dict[tuple[int, str], Counts] = {}


def _counter(frequent: Broadcast, tokenizer_path: str):
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        key = (id(frequent.value), tokenizer_path)
        if key not in _COUNTS:
            _COUNTS.clear()
            _COUNTS[key] = Counts(frequent.value, tokenizer_path)
        counts = _COUNTS[key]
        for batch in texts:
            yield pd.Series([counts.count(t) for t in batch], dtype="int64")

    return run


def with_token_counts(
    docs: DataFrame, tokenizer_path: str, text: str = "text", into: str = "n_tokens"
) -> DataFrame:
    """``docs`` with the number of tokens of each whole text, as ``tokenizers`` gives them.

    No begin, end or other special tokens are added; special strings inside a text count as the
    library does by default.  The tokenizer must drop white space (as those with word ends do).
    A null text counts as empty (0 tokens); ids, ties, repeated rows and other columns don't
    matter, and an empty table stays empty.  A column named like ``into`` is replaced.
    """
    texts = docs.select(text_of(text).alias("text"))
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_pretokens(texts, tokenizer_path))
    counted = F.pandas_udf(_counter(frequent, tokenizer_path), "long")
    return docs.withColumn(into, counted(text_of(text)))
