from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from landflow.llm import chunk_bpe, token_counts
from tests.llm.conftest import answers, in_order

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def library(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_counts_equal_the_library(documents, rows):
    counted = token_counts.with_token_counts(documents, WORDS)
    want = [(i, len(e)) for (i, _), e in zip(rows, library(WORDS, [t for _, t in rows]), strict=True)]
    assert answers(counted, "doc_id", "n_tokens") == in_order(want)
    assert set(counted.columns) == set(documents.columns)


def test_counts_do_not_depend_on_the_tiers(monkeypatch, documents):
    whole = answers(token_counts.with_token_counts(documents, WORDS), "doc_id", "n_tokens")
    texts = documents.select(F.coalesce("text", F.lit("")).alias("text"))
    none = token_counts.Counts(token_counts.Frequent("", b""), WORDS)
    monkeypatch.setattr(token_counts, "HELD", 5)
    assert sorted(none.count(r[0]) for r in texts.collect()) == sorted(n for _, n in whole)


def test_the_table_has_the_frequent_ones(spark):
    texts = spark.createDataFrame([("often often rare",), ("often other",)] * 4, "text string").repartition(6)
    table = token_counts.frequent_pretokens(texts, WORDS)
    assert table.words.split("\n")[0] == "often"
    assert sorted(table.words.split("\n")) == ["often", "other", "rare"]


def test_no_rows(no_documents):
    assert token_counts.with_token_counts(no_documents, WORDS).collect() == []
    assert chunk_bpe.encode(no_documents, BYTES).collect() == []


def test_ids_equal_the_library_and_decode(documents, rows):
    encoded = chunk_bpe.encode(documents, BYTES)
    found = answers(encoded.select("id", "ids", chunk_bpe.decoded(F.col("ids"), BYTES).alias("text")), "id", "ids", "text")
    texts, own = [t or "" for _, t in rows], Tokenizer.from_file(BYTES)
    ids = library(BYTES, texts)
    want = [
        (i, np.array(e, "<u4").tobytes(), own.decode(e, skip_special_tokens=False))
        for (i, _), e in zip(rows, ids, strict=True)
    ]
    assert in_order((i, bytes(b), t) for i, b, t in found) == in_order(want)


@pytest.mark.parametrize("least", [4, 16])
def test_joins_within_words_are_repaired(monkeypatch, rows, least):
    """With very short chunks, all of them shared, nearly every join falls within a word."""
    monkeypatch.setattr(chunk_bpe, "LEAST", least)
    monkeypatch.setattr(chunk_bpe, "ABOUT", least)
    monkeypatch.setattr(chunk_bpe, "GRAM", 4)
    own = chunk_bpe.Encoder(BYTES)
    texts = [t for _, t in rows if t and len(t) < 20_000]
    for text, want in zip(texts, library(BYTES, texts), strict=True):
        data = text.encode()
        ends = chunk_bpe.cuts_of([data])[0]
        parts = chunk_bpe._parts(data, ends)
        assert b"".join(parts) == data
        for known in ({}, dict(enumerate(parts)), dict(list(enumerate(parts))[::2])):
            ids = own.joined(data, ends, {n: own.whole(p.decode()) for n, p in known.items()})
            assert np.frombuffer(ids, "<u4").tolist() == want


def test_a_passage_is_cut_alike_wherever_it_stands():
    passage = b" ".join(b"w%d" % (k * k % 9973) for k in range(4000))
    one, two = chunk_bpe.cuts_of([b"abc " * 100 + passage, b"other " * 333 + passage])
    mine, other = set(chunk_bpe._parts(b"abc " * 100 + passage, one)), set(chunk_bpe._parts(b"other " * 333 + passage, two))
    assert len(mine & other) > 0.7 * len(mine)
