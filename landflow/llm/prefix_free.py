"""Removal of repeated passages by prefix-free parsing.

A byte goes if it is covered by a string of ``width`` bytes that also starts earlier.  Only the
corpus order down to that depth matters, and only its classes of equal strings:

* *Triggers*: a window of ``width`` bytes is named by its ``gram``-byte run with the smallest rolling
  hash (the leftmost of equal ones), so equal windows have the trigger at the same place.
* *Phrases*: neighbouring windows with one trigger form a phrase.  Phrases overlap by ``width - 1``
  bytes, hence every window lies in exactly one phrase of the parse, and the strings to be ordered
  are exactly the suffixes, ``width`` bytes or longer, of the dictionary's phrases.
* *Parse order*: occurrences sorted by trigger, phrase and place show the first of each phrase.  All
  windows of the other occurrences start earlier, too; the first ones are the dictionary, each entry
  standing for its place in the corpus.
* *Dictionary order*: only phrases with a common trigger can share suffixes.  Where a trigger has
  several phrases, their suffixes are first compared in blocks of neighbours by the bytes that all
  suffixes of a block have in common.  Of blocks that agree so far, the suffixes, cut to ``width``
  bytes, are sorted by a hash of their bytes and by place; all but the first of equal ones start
  earlier as well.

No suffix array is built, neither of the dictionary nor of the parse: the answer needs classes of equal
strings of ``width`` bytes and their first places, not the order between classes, so classes by hash
within a trigger replace both.  Strings of equal hashes count as equal; their bytes are not compared.

Repetitive text is thus resolved phrase by phrase; suffixes are listed only around its edges.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landflow.llm.common import settled, shuffle_partitions
from landflow.llm.hashing import Rolling, blocks, mix

_U = np.uint64
#: Bits of a position in a piece; longer texts are cut into pieces that overlap by ``width - 1``.
_PLACE = 28
PIECE = 4 << 20
#: Blocks into which a trigger's suffixes are divided.
BLOCKS = 4
#: A phrase's shape holds its number of windows and, above these bits, the trigger's distance from its start.
_SHAPE = 12


def _sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    span, least = 1, keys
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    return np.minimum(least[: len(least) - (width - span)], least[width - span :]) if width > span else least


def phrases(texts: list[bytes], width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of every phrase: its text, start, shape, trigger and content."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    if len(data) < width:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    rolling = Rolling(data)
    grams = rolling.grams(gram)
    places = np.arange(len(grams), dtype=np.uint64)
    least = _sliding_min((grams >> _U(_PLACE) << _U(_PLACE)) | places, width - gram + 1)
    trigger = (least & _U((1 << _PLACE) - 1)).astype(np.int64)
    whole = np.zeros(len(data) + 1, np.int64)  # windows that lie within one text
    lasts = np.maximum(offsets[1:] - width + 1, offsets[:-1])
    np.add.at(whole, offsets[:-1], 1)
    np.add.at(whole, lasts, -1)
    at = np.flatnonzero(np.cumsum(whole)[: len(trigger)])
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    named = trigger[at]
    opens = np.flatnonzero(np.concatenate([[True], named[1:] != named[:-1]]))
    starts = at[opens]
    counts = np.diff(np.concatenate([opens, [len(at)]]))
    text = np.searchsorted(offsets, starts, "right") - 1
    content = rolling.spans(starts, starts + counts + width - 1)
    shape = counts + ((named[opens] - starts) << _SHAPE)
    return text, starts - offsets[text], shape, grams[named[opens]].view(np.int64), content.view(np.int64)


def _pieces(text: bytes, width: int) -> list[tuple[int, bytes]]:
    if len(text) <= PIECE:
        return [(0, text)]
    return [(a, text[a : a + PIECE + width - 1]) for a in range(0, len(text) - width + 1, PIECE)]


_ENTRY = "trigger long, content long, id long, start int, shape int"
_NAMES = ["trigger", "content", "id", "start", "shape"]


def _entries(trigger, content, ids, start, shape) -> pa.RecordBatch:
    columns = [trigger, content, ids, start.astype(np.int32), shape.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _NAMES)



def _parse(batches: Iterator[pa.RecordBatch], width: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for first, texts in blocks(batch.column(1).to_pylist()):
            cut = [(row, a, piece) for row, t in enumerate(texts, first) for a, piece in _pieces(t, width)]
            rows, shift = (np.array(c, np.int64) for c in ([c[0] for c in cut], [c[1] for c in cut]))
            text, start, shape, trigger, content = phrases([c[2] for c in cut], width, gram)
            yield _entries(trigger, content, ids[rows[text]], start + shift[text], shape)


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From entries sorted by trigger, content, id and start: those that are not the first of their
    content (``entry`` false), and the first ones of triggers with several contents (``entry`` true)."""
    held: list[np.ndarray] | None = None  # the first entry of the content read last
    shared = False  # whether its trigger had another content before

    def out(columns: list[np.ndarray], entry: bool) -> pa.RecordBatch:
        arrays = [pa.array(c) for c in (columns[0], columns[2], columns[3], columns[4])]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(np.full(len(columns[0]), entry))], ["trigger", "id", "start", "shape", "entry"])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(n).to_numpy() for n in _NAMES]
        if held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns, strict=True)]
        trigger, content, ids, start, _ = columns
        new_trigger = np.concatenate([[not shared], trigger[1:] != trigger[:-1]])
        new = np.concatenate([[True], (trigger[1:] != trigger[:-1]) | (content[1:] != content[:-1])])
        opens = np.flatnonzero(new)
        origin = opens[np.cumsum(new) - 1]
        later = (ids != ids[origin]) | (start != start[origin])
        if later.any():
            yield out([c[later] for c in columns], False)
        after = ~new_trigger[opens]  # the trigger had a content before
        before = np.concatenate([after[1:], [False]])
        ready = opens[:-1][(after | before)[:-1]]
        if len(ready):
            yield out([c[ready] for c in columns], True)
        held, shared = [c[opens[-1] :][:1] for c in columns], bool(after[-1])
    if held is not None and shared:
        yield out(held, True)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of entries sorted by trigger and content: those with the same of both as another one."""
    held: list[np.ndarray] | None = None  # the last entry, if its content has not been met again so far
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(n).to_numpy() for n in _NAMES]
        if held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns, strict=True)]
        trigger, content = columns[:2]
        again = np.concatenate([[last == (trigger[0], content[0])], (trigger[1:] == trigger[:-1]) & (content[1:] == content[:-1])])
        out = again | np.concatenate([again[1:], [False]])
        held = None if out[-1] else [c[-1:] for c in columns]
        last = (trigger[-1], content[-1]) if out[-1] else None
        if out.any():
            yield _entries(*(c[out] for c in columns))


def _listed(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, tuple[np.ndarray, ...]]]:
    """Of each text that has listed phrases: its id, its bytes, and their triggers, starts and shapes."""
    ids, lists = batch.column(0).fill_null(0).to_numpy(), batch.column(2)  # rows without id have no list
    for first, texts in blocks(batch.column(1).to_pylist()):
        for row, text in enumerate(texts, first):
            if lists[row].is_valid:
                trigger, start, shape = (c.to_numpy() for c in lists[row].values.flatten())
                yield ids[row], np.frombuffer(text, np.uint8), (trigger, start.astype(np.int64), shape.astype(np.int64))


def _fits(data: np.ndarray, found: tuple[np.ndarray, ...], width: int) -> tuple[np.ndarray, ...]:
    fits = found[1] + (found[2] & ((1 << _SHAPE) - 1)) + width - 1 <= len(data)
    return tuple(c[fits] for c in found)


def _cores(batches: Iterator[pa.RecordBatch], width: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The blocks of the listed phrases' suffixes, each named by the bytes common to its suffixes."""
    size = -(-(width - gram + 1) // BLOCKS)
    for batch in batches:
        for doc, data, found in _listed(batch):
            trigger, start, shape = _fits(data, found, width)
            if not len(start):
                continue
            windows, ahead = shape & ((1 << _SHAPE) - 1), shape >> _SHAPE
            place = start + ahead - (width - gram)  # where the trigger's first block would begin
            parts = []
            for block in range(BLOCKS):
                low = np.maximum(start, place + block * size)
                high = np.minimum(start + windows, place + (block + 1) * size)
                some = low < high
                core = place[some] + (block + 1) * size - 1
                parts.append((trigger[some], np.full(some.sum(), block), core, place[some] + block * size + width, low[some], (high - low)[some]))
            trigger, block, begin, end, low, count = (np.concatenate(c) for c in zip(*parts, strict=True))
            content = mix(Rolling(data).spans(begin, end) + block.astype(np.uint64)).view(np.int64)
            yield _entries(trigger, content, np.full(len(low), doc), low, count)


def _suffixes(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Every suffix of the listed blocks, cut to ``width`` bytes."""
    for batch in batches:
        for doc, data, found in _listed(batch):
            trigger, start, windows = _fits(data, found, width)
            if not len(start):
                continue
            at = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows - start, windows)
            content = Rolling(data).spans(at, at + width).view(np.int64)
            yield _entries(np.repeat(trigger, windows), content, np.full(len(at), doc), at, np.ones(len(at), np.int32))


_CUT = "id long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary"


def _cut(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    for batch in batches:
        sizes, spans, kept, ids = [], [], [], batch.column(0)
        for first, texts in blocks(batch.column(1).to_pylist()):
            for row, text in enumerate(texts, first):
                depth = np.zeros(len(text) + 1, np.int64)
                if batch.column(2)[row].is_valid:
                    start, shape = (c.to_numpy().astype(np.int64) for c in batch.column(2)[row].values.flatten())
                    windows = shape & ((1 << _SHAPE) - 1)
                    np.add.at(depth, np.minimum(start, len(text)), 1)
                    np.add.at(depth, np.minimum(start + windows + width - 1, len(text)), -1)
                gone = np.concatenate([[False], np.cumsum(depth[:-1]) > 0, [False]])
                edge = np.flatnonzero(gone[1:] != gone[:-1])
                sizes.append(len(text))
                spans.append([{"start": x, "end": y} for x, y in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)])
                kept.append(np.frombuffer(text, np.uint8)[~gone[1:-1]].tobytes())
        columns = [ids, pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "spans", "kept"])


_FIRSTS = "trigger long, id long, start int, shape int, entry boolean"


def _in_order(entries: DataFrame, *keys: str) -> DataFrame:
    parts = shuffle_partitions(entries.sparkSession)
    return entries.repartition(parts, *keys).sortWithinPartitions("trigger", "content", "id", "start")


def _lists(entries: DataFrame, *columns: str) -> DataFrame:
    """The entries of each text; a text has a bounded number of them for its length."""
    return entries.groupBy("id").agg(F.collect_list(F.struct(*columns)).alias("list")).hint("shuffle_hash")


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    width: int = 100,
    gram: int = 32,
) -> DataFrame:
    """One row per document: ``id``, ``n_bytes``, the removed ``spans`` and the ``kept`` bytes.

    Texts are UTF-8 bytes (null: empty); strings never cross documents.  Earlier means a smaller id,
    or the same text and an earlier start; all strings are judged on the input.  Texts shorter than
    ``width`` keep everything, and so do rows without an id, which are compared with nothing.  A
    repeated row is the same document again and gets the same result; texts that share an id get each
    other's removals, within their length.  Other columns don't matter; an empty table stays empty.
    """
    docs = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    parsed = docs.where("id is not null").mapInArrow(partial(_parse, width=width, gram=gram), _ENTRY)
    found = settled(_in_order(parsed, "trigger").mapInArrow(_firsts, _FIRSTS), "phrases")
    # all joins are left joins, so that they read one shuffle of the texts
    texts = docs.repartition(shuffle_partitions(docs.sparkSession), "id")
    entries = _lists(found.where("entry"), "trigger", "start", "shape")
    cores = texts.join(entries, "id", "left").mapInArrow(partial(_cores, width=width, gram=gram), _ENTRY)
    cores = _in_order(cores, "trigger", "content").mapInArrow(_shared, _ENTRY)
    suffixes = texts.join(_lists(cores, "trigger", "start", "shape"), "id", "left")
    suffixes = suffixes.mapInArrow(partial(_suffixes, width=width), _ENTRY)
    edges = _in_order(suffixes, "trigger", "content").mapInArrow(_firsts, _FIRSTS)
    spans = _lists(found.where("not entry").union(edges.where("not entry")), "start", "shape")
    return texts.join(spans, "id", "left").mapInArrow(partial(_cut, width=width), _CUT)
