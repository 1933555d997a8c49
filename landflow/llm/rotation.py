"""Fill-in-the-middle: a document's middle is moved behind its suffix, in place, and back.

A text is cut into units (a run of A-Z and a-z, or any other single code point).  Two of its unit
boundaries, drawn from a digest of the document's id, part it into prefix, middle and suffix.  The
sentinels are inserted into one ``bytearray`` in the order of the text, and neighbouring segments are
then exchanged by three reversals, so no second copy of a segment is ever put together::

    psm   <P>prefix [<M>middle][<S>suffix]   ->  <P>prefix<S>suffix<M>middle
    spm   [<P>prefix<M>middle][<S>suffix]    ->  <S>suffix<P>prefix<M>middle

The inverse finds the sentinels, rotates the same segments back and deletes the sentinels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landflow.llm.hashing import trim_memory

#: The marks before prefix, suffix and middle.
P, S, M = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


@dataclass(frozen=True)
class Draw:
    """Shares of a hundred: texts that are transformed, and those of them that put the suffix first."""

    rate: int = 90
    spm: int = 20
    seed: int = 1

    def numbers(self, doc_id: int | None) -> list[int]:
        """Four unsigned 32-bit numbers; a missing id draws those of an empty one."""
        name = f"{self.seed}:{'' if doc_id is None else doc_id}"
        digest = hashlib.sha256(name.encode()).hexdigest()
        return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def unit_starts(data: bytes) -> np.ndarray:
    """Where each unit of a UTF-8 text starts, and the text's length."""
    b = np.frombuffer(data, np.uint8)
    letter = _LETTER[b]
    start = ~letter & ((b & 0xC0) != 0x80)
    start |= letter
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.append(np.flatnonzero(start), len(b))


def code_points(data: memoryview | bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def exchange(buffer: bytearray, left: int, between: int, right: int) -> None:
    """Swap the segments ``left:between`` and ``between:right`` by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    for a, b in ((left, between), (between, right), (left, right)):
        view[a:b] = view[a:b][::-1].copy()


def insert(buffer: bytearray, at: int, mark: bytes) -> None:
    buffer[at:at] = mark


def rotate(buffer: bytearray, first: int, second: int, form: str) -> None:
    """Turn a text, cut at two byte positions, into ``form``."""
    for at, mark in ((second, S), (first, M), (0, P)):  # from behind, so that positions stay right
        insert(buffer, at, mark)
    middle, suffix = first + len(P), second + len(P) + len(M)
    exchange(buffer, middle if form == PSM else 0, suffix, len(buffer))


def restore(buffer: bytearray, form: str) -> None:
    """The inverse of :func:`rotate`.  No sentinel is part of the text, and none overlaps another."""
    if form == PLAIN:
        return
    if form == PSM:
        suffix, middle = buffer.index(S), buffer.index(M)
        exchange(buffer, suffix, middle, len(buffer))
    else:
        exchange(buffer, 0, buffer.index(P), len(buffer))
    for mark in (S, M, P):
        at = buffer.index(mark)
        del buffer[at : at + len(mark)]


def transform(data: bytes, numbers: list[int], draw: Draw) -> tuple[int, str, int | None, int | None, bytearray]:
    """Units, form, code points of prefix and middle (None if plain), and the new text."""
    h1, h2, h3, h4 = numbers
    starts = unit_starts(data) if data else np.zeros(1, np.int64)
    n = len(starts) - 1
    buffer = bytearray(data)
    if not data or h3 % 100 >= draw.rate or any(mark in data for mark in (P, S, M)):
        return n, PLAIN, None, None, buffer
    form = SPM if h4 % 100 < draw.spm else PSM
    first, second = (int(starts[u]) for u in sorted((h1 % (n + 1), h2 % (n + 1))))
    counts = code_points(data[:first]), code_points(data[first:second])
    rotate(buffer, first, second, form)
    return n, form, *counts, buffer


def _transformed(batches: Iterator[pa.RecordBatch], draw: Draw, check: bool) -> Iterator[pa.RecordBatch]:
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    for batch in batches:
        trim_memory()
        rows: list[tuple] = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = (text.as_py() or "").encode()
            found = transform(data, draw.numbers(doc_id), draw)
            output = bytes(found[4])
            if check:
                restore(found[4], found[1])
            rows.append((doc_id, *found[:4], output, bytes(found[4]) if check else None))
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([*arrays[:5], *[a.cast(pa.string()) for a in arrays[5:]]], names)


def fill_in_middle(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", draw: Draw = Draw(), check: bool = False
) -> DataFrame:
    """One row per document: ``id, n, form, prefix_chars, middle_chars, output, restored``.

    ``n`` counts a text's units.  ``form`` is plain if the text is empty or null, holds a sentinel
    or is not drawn; its output is the text and its counts are null.  ``restored`` is rebuilt from
    output and form if ``check`` asks for it, else null.  Rows are transformed one by one, without a
    shuffle: repeated rows give equal results, rows without an id draw as an empty id does, other columns
    don't matter, and an empty table gives an empty result.  A very long text costs its task a few
    copies of itself.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = "id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string"
    return rows.mapInArrow(partial(_transformed, draw=draw, check=check), schema)


def restored_text(docs: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``docs`` with ``restored``: the texts that ``output`` and ``form`` come from; null gives null."""
    kept = [f for f in docs.schema.fields if f.name != "restored"]
    names = [f.name for f in kept]

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for data, kind in zip(batch.column(names.index(output)), batch.column(names.index(form)).to_pylist(), strict=True):
                buffer = None if data.as_py() is None or kind is None else bytearray(data.as_py().encode())
                if buffer is not None:
                    restore(buffer, kind)
                texts.append(None if buffer is None else buffer.decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, "restored"])

    schema = docs.select(*[f"`{n}`" for n in names]).schema.add("restored", "string")
    return docs.select(*[f"`{n}`" for n in names]).mapInArrow(rebuilt, schema)


def rotation_sql(draw: Draw = Draw()) -> str:
    """DuckDB SQL for the digests of :func:`fill_in_middle` over ``documents``."""
    letters = "[A-Za-z]+|[^A-Za-z]"
    number = lambda k: f"CAST(concat('0x', substr(h, {8 * k + 1}, 8)) AS BIGINT)"
    return f"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   sha256(concat('{draw.seed}:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS h FROM documents),
        u AS (SELECT *, regexp_extract_all(text, '{letters}') AS units, {", ".join(f"{number(k)} AS h{k + 1}" for k in range(4))} FROM d),
        c AS (
            SELECT *, CAST(len(units) AS BIGINT) AS n,
                   least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS one,
                   greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS two,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR h3 % 100 >= {draw.rate} THEN 'plain'
                        WHEN h4 % 100 < {draw.spm} THEN 'spm' ELSE 'psm' END AS form FROM u),
        p AS (
            SELECT *, array_to_string(list_slice(units, 1, one), '') AS prefix,
                   array_to_string(list_slice(units, one + 1, two), '') AS middle,
                   array_to_string(list_slice(units, two + 1, n), '') AS suffix FROM c)
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                                WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle)
                                ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM p"""
