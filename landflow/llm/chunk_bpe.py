"""BPE encoding with content-defined chunks that are shared between documents, and decoding.

* A rolling hash cuts every text into chunks at places its content decides, so a passage that
  recurs is cut alike wherever it stands (apart from its rims).
* Chunks that occur more than once are counted by digest; one occurrence of each is encoded, once,
  and its ids are joined to all others.  Everything between shared chunks is encoded where it stands.
* Chunks are cut anywhere, even within a word, so tokens next to a join can differ from those of the
  whole text.  Each join is repaired: the stretch from the last safe place before it to the first one
  after it is encoded anew.  A place is *safe* between a visible character and a blank, where no token
  crosses whatever surrounds it.  The ids on both sides must agree with the pieces they replace, and
  the stretch is widened to the whole text where they don't.

For byte-level BPE without normaliser, whose pre-tokens take white space only at their start.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landflow.llm.common import settled, shuffle_partitions
from landflow.llm.hashing import Rolling, blocks, trim_memory
from landflow.llm.token_counts import tokenizer

#: Bytes of a chunk: at least, about, at most.
LEAST, ABOUT, MOST = 256, 1024, 8192
#: Bytes that the rolling hash sees.
GRAM = 48
#: Units that a worker's cache holds, and the longest that it keeps.
HELD, KEPT_CHARS = 200_000, 64

_UNIT = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
#: White space that only some definitions have; next to it no place counts as safe.
_ODD = "\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f\u2060\u3000\ufeff"
_HAS_ODD = re.compile(f"[{_ODD}]")
_SAFE = re.compile(rf"(?<=[^ \t\n\r{_ODD}])[ \t\n\r]")


# ------------------------------------------------------------------ chunks


def cuts_of(texts: list[bytes]) -> list[list[int]]:
    """The ends of each text's chunks; an empty text has none."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    marks = np.flatnonzero(Rolling(data).grams(GRAM) % np.uint64(ABOUT) == 0) + GRAM if len(data) > GRAM else np.zeros(0, np.int64)
    found, offset = [], 0
    for text in texts:
        low, high = np.searchsorted(marks, [offset + GRAM, offset + len(text)])
        ends, last = [], 0
        for mark in [*(marks[low:high] - offset).tolist(), len(text)]:
            while mark - last > MOST:
                last = _character(text, last + MOST)
                ends.append(last)
            if mark - last >= LEAST and mark < len(text) and (end := _character(text, mark)) < len(text):
                ends.append(end)
                last = end
        if text:
            ends.append(len(text))
        found.append(ends)
        offset += len(text)
    return found


def _character(text: bytes, place: int) -> int:
    """The start of the first character at or after ``place``."""
    while place < len(text) and text[place] & 0xC0 == 0x80:
        place += 1
    return place


def _parts(text: bytes, ends: list[int]) -> list[bytes]:
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


# ------------------------------------------------------------------ encoding in a worker


class Encoder:
    """Encodes texts as the library does, unit by unit through a cache: a unit is a word with the blanks before it."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.held: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if _HAS_ODD.search(text):
            return self.whole(text)
        units = _UNIT.findall(text)
        try:
            return b"".join(map(self.held.__getitem__, units))
        except KeyError:
            pass
        if len(self.held) > HELD:  # the oldest entries are the commonest units
            self.held = dict(islice(self.held.items(), HELD // 2))
        missing = list(set(units).difference(self.held))
        found = self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)
        self.held.update(zip(missing, (np.array(e.ids, "<u4").tobytes() for e in found), strict=True))
        ids = b"".join(map(self.held.__getitem__, units))
        for unit in missing:
            if len(unit) > KEPT_CHARS:
                del self.held[unit]
        return ids

    def joined(self, text: bytes, ends: list[int], known: dict[int, bytes]) -> bytes:
        """The ids of a text, given those of some of its chunks."""
        if not known:
            return self.encode(text.decode("utf-8", "surrogatepass"))
        pieces: list[tuple[str, bytes | None]] = []
        for nth, part in enumerate(_parts(text, ends)):
            ids, chars = known.get(nth), part.decode("utf-8", "surrogatepass")
            if ids is not None and not _SAFE.search(chars):
                ids = None  # no join with it could be repaired
            if ids is None and pieces and pieces[-1][1] is None:
                pieces[-1] = (pieces[-1][0] + chars, None)
            else:
                pieces.append((chars, ids))
        out, before = b"", ""
        for chars, ids in pieces:
            ids = self.encode(chars) if ids is None else ids
            repaired = self._repaired(out, before, ids, chars) if before else ids
            if repaired is None:
                return self.encode(text.decode("utf-8", "surrogatepass"))
            out, before = repaired, chars
        return out

    def _repaired(self, left: bytes, left_text: str, right: bytes, right_text: str) -> bytes | None:
        """The ids of both sides with the stretch around their join encoded anew; none if they don't agree."""
        first = _SAFE.search(right_text)
        last = None
        for last in _SAFE.finditer(left_text, max(0, len(left_text) - 64)):
            pass
        if last is None:
            for last in _SAFE.finditer(left_text):
                pass
        if last is None or first is None:
            return None
        a, b = left_text[last.start() :], right_text[: first.start()]
        tail, head = self.encode(a), self.encode(b)
        if not left.endswith(tail) or not right.startswith(head):
            return None
        return left[: len(left) - len(tail)] + self.encode(a + b) + right[len(head) :]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ------------------------------------------------------------------ inside tasks


def _packed(ids: bytes, press: zstandard.ZstdCompressor) -> bytes:
    """Ids for a shuffle: two bytes each where they fit, compressed."""
    wide = np.frombuffer(ids, "<u4")
    fits = not len(wide) or wide.max() < 1 << 16
    return (b"n" + press.compress(wide.astype("<u2").tobytes())) if fits else b"w" + press.compress(ids)


def _unpacked(packed: bytes, unpack: zstandard.ZstdDecompressor) -> bytes:
    plain = unpack.decompress(packed[1:])
    return np.frombuffer(plain, "<u2").astype("<u4").tobytes() if packed[:1] == b"n" else plain


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of every chunk."""
    for batch in batches:
        k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for first, texts in blocks(batch.column(2).to_pylist()):
            rows, nth, digest = [], [], []
            for row, (text, ends) in enumerate(zip(texts, cuts_of(texts), strict=True), first):
                rows += [row] * len(ends)
                nth += range(len(ends))
                digest += [hashlib.blake2b(p, digest_size=16).digest() for p in _parts(text, ends)]
            at = np.array(rows, np.int64)
            columns = [pa.array(k1[at]), pa.array(k2[at]), pa.array(nth, pa.int32()), pa.array(digest, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "nth", "digest"])


def _pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        body, cuts = [], []
        for _, texts in blocks(batch.column("text").to_pylist()):
            body += map(press.compress, texts)
            cuts += [np.array(ends, "<i4").tobytes() for ends in cuts_of(texts)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("id", "k1", "k2")), pa.array(body, pa.binary()), pa.array(cuts, pa.binary())],
            ["id", "k1", "k2", "body", "cuts"],
        )


def _read(batch: pa.RecordBatch, row: int, unpack) -> tuple[bytes, list[int]]:
    return unpack.decompress(batch.column("body")[row].as_py()), np.frombuffer(batch.column("cuts")[row].as_py(), "<i4").tolist()


def _encode_shared(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    press, unpack, own = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor(), encoder(path)
    for batch in batches:
        digest, ids = [], []
        for row, listed in enumerate(batch.column("list").to_pylist()):
            if not listed:
                continue
            text, ends = _read(batch, row, unpack)
            parts = _parts(text, ends)
            for entry in listed:
                digest.append(entry["digest"])
                own_ids = own.encode(parts[entry["nth"]].decode("utf-8", "surrogatepass"))
                ids.append(_packed(own_ids, press))
        yield pa.RecordBatch.from_pydict({"digest": pa.array(digest, pa.binary()), "ids": pa.array(ids, pa.binary())})


def _encode_rows(batches: Iterator[pa.RecordBatch], path: str, decode: bool) -> Iterator[pa.RecordBatch]:
    unpack, own = zstandard.ZstdDecompressor(), encoder(path)
    for batch in batches:
        trim_memory()
        ids, first, size = [], 0, 0
        for row in range(batch.num_rows):
            text, ends = _read(batch, row, unpack)
            listed = batch.column("list")[row].as_py()
            ids.append(own.joined(text, ends, {e["nth"]: _unpacked(e["ids"], unpack) for e in listed or ()}))
            size += len(ids[-1])
            if size > 2 << 20 or row == batch.num_rows - 1:
                columns = {"id": batch.column("id").slice(first, len(ids)), "ids": pa.array(ids, pa.binary())}
                if decode:
                    columns["decoded"] = pa.array([text_of_ids(i, path) for i in ids], pa.string())
                yield pa.RecordBatch.from_pydict(columns)
                ids, first, size = [], row + 1, 0


# ------------------------------------------------------------------ the operators


def encode(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text: str = "text", decode: bool = False
) -> DataFrame:
    """One row per document: ``id`` and ``ids`` (binary: little-endian unsigned 32-bit numbers).

    With ``decode`` the ids are also turned back into text, in the same task (column ``decoded``).
    The ids are those that ``tokenizers`` gives for the whole text with ``add_special_tokens=False``,
    without truncation or padding.  A null text counts as empty and has no ids.  Null and repeated ids
    and repeated rows are returned as often as they come; other columns don't matter; an empty table
    stays empty.
    """
    parts = shuffle_partitions(docs.sparkSession)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        F.xxhash64(F.col(f"`{id_column}`").cast("string")).alias("k1"),
        F.xxhash64(body).alias("k2"),  # rows are told apart by id and text
        body.alias("text"),
    )
    kinds = "k1 long, k2 long, nth int, digest binary"
    chunks = settled(rows.select("k1", "k2", "text").mapInArrow(_occurrences, kinds), "chunks")
    shared = chunks.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "nth")).alias("at"))
    shared = shared.where("n > 1").select("digest", "at.*")
    owners = shared.groupBy("k1", "k2").agg(F.collect_list(F.struct("nth", "digest")).alias("list"))
    owners = owners.withColumn("list", F.array_distinct("list"))
    pressed = rows.mapInArrow(_pressed, f"id {rows.schema['id'].dataType.simpleString()}, k1 long, k2 long, body binary, cuts binary")
    pressed = pressed.repartition(parts, "k1", "k2")
    # left joins both, so that both read one shuffle of the texts
    once = pressed.join(owners.hint("shuffle_hash"), ["k1", "k2"], "left").mapInArrow(
        partial(_encode_shared, path=tokenizer_path), "digest binary, ids binary"
    )
    once = once.groupBy("digest").agg(F.first("ids").alias("ids"))  # repeated rows encode alike
    uses = chunks.join(once, "digest").select("k1", "k2", "nth", "ids")
    uses = uses.repartition(parts, "k1", "k2").dropDuplicates(["k1", "k2", "nth"])
    uses = uses.groupBy("k1", "k2").agg(F.collect_list(F.struct("nth", "ids")).alias("list"))
    return pressed.join(uses.hint("shuffle_hash"), ["k1", "k2"], "left").mapInArrow(
        partial(_encode_rows, path=tokenizer_path, decode=decode),
        f"id {rows.schema['id'].dataType.simpleString()}, ids binary" + (", decoded string" if decode else ""),
    )


def byte_of_character() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves,
    the others for the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


_PIECES: dict[str, dict[int, bytes]] = {}


def pieces(path: str) -> dict[int, bytes]:
    """The bytes of every id."""
    if path not in _PIECES:
        of = byte_of_character()
        vocabulary = tokenizer(path).get_vocab(with_added_tokens=True)
        _PIECES[path] = {
            n: bytes(of[c] for c in token) if all(c in of for c in token) else token.encode() for token, n in vocabulary.items()
        }
    return _PIECES[path]


def text_of_ids(ids: bytes, path: str) -> str:
    """What ids decode to.  Bytes that are no UTF-8 become replacement characters, as the library does it."""
    of = pieces(path)
    return b"".join(map(of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def decoded(ids: Column, tokenizer_path: str) -> Column:
    """The text of a column of ids as :func:`encode` returns them (null: null), special tokens included."""

    @F.pandas_udf("string")
    def run(batch: pd.Series) -> pd.Series:
        trim_memory()
        return batch.map(lambda ids: text_of_ids(ids, tokenizer_path), na_action="ignore")

    return run(ids)
