"""WARC archives with revisit records.

Payload headers (page, digest, length) are shuffled by digest to find the first page of each
payload; the others become ``revisit`` records that name it and carry no payload.  Records get fresh
headers and are written as gzip-compressed archives of bounded size by Spark's text writer: records
end in two line breaks, which is the writer's separator.  Reading parses by Content-Length, checks
payloads against their digests, and joins revisits to the responses that hold their payload.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landflow.llm.common import settled, text_of

#: Payload bytes of an archive, about.
ARCHIVE_BYTES = 16 << 20
BREAK = "\r\n"
VERSION = "WARC/1.1"
#: Fixed values of the format: the profile of a revisit that repeats a payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(data: Column) -> Column:
    """SHA-1 in upper-case base 32: 160 bits as four groups of eight digits."""
    digits = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digits, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*groups), HEX32, BASE32)


def record_id(page_id: Column, digest: Column, copy: Column) -> Column:
    """A URN that the page's id, its payload and the number of its copy decide."""
    named = F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("null")), digest, copy.cast("string"))
    h = F.md5(named.cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def payload_headers(pages: DataFrame, id_column: str = "page_id", payload: str = "html") -> DataFrame:
    """Page id, digest and length of every payload (null: empty)."""
    body = text_of(payload)
    return pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"),
        sha1_base32(body.cast("binary")).alias("digest"),
        F.octet_length(body).cast("long").alias("bytes"),
    )


def originals(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Of every payload of ``least_bytes`` or more that occurs at least twice, the smallest page id.

    Null ids count as larger than any, so they are originals only of payloads that no other page has.
    """
    return (
        headers.where(F.col("bytes") >= least_bytes)
        .groupBy("digest", "bytes")
        .agg(F.min("page_id").alias("origin"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )


def resolved(pages: DataFrame, id_column: str, payload: str, url: str, least_bytes: int) -> DataFrame:
    """Every page with ``record_type``, ``refers_to`` and, for responses only, its payload.

    Rows that repeat a page id and payload are numbered (``copy``); only the first can be a response.
    """
    headers = payload_headers(pages, id_column, payload)
    first = settled(originals(headers, least_bytes), "originals")
    # repeats of one id and payload, which ids should not have: few, if any
    repeats = headers.groupBy("page_id", "digest", "bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeats = settled(repeats.drop("n"), "repeats")
    keyed = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"),
        F.coalesce(F.col(f"`{url}`"), F.lit("")).alias("url"),
        text_of(payload).alias("payload"),
    )
    keyed = keyed.withColumn("digest", sha1_base32(F.col("payload").cast("binary")))
    keyed = keyed.withColumn("bytes", F.octet_length("payload").cast("long"))
    rows = keyed.join(first, ["digest", "bytes"], "left")
    revisit = F.col("origin").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("origin"))
    rows = rows.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
    rows = rows.withColumn("copy", F.lit(0))
    if repeats.isEmpty():
        return rows
    same = [rows["page_id"].eqNullSafe(repeats["page_id"]), rows["digest"] == repeats["digest"], rows["bytes"] == repeats["bytes"]]
    many = rows.join(repeats, same, "left_semi")
    numbered = many.drop("copy").withColumn("copy", _copy_number())
    turned = numbered.withColumn(
        "record_type",
        F.when((F.col("copy") > 0) & (F.col("bytes") >= least_bytes), "revisit").otherwise(F.col("record_type")),
    )
    return rows.join(repeats, same, "left_anti").unionByName(turned)


def _copy_number() -> Column:
    return F.row_number().over(Window.partitionBy("page_id", "digest", "bytes").orderBy("url")) - 1


def records(rows: DataFrame, date: str) -> DataFrame:
    """Each row of :func:`resolved` as one WARC record, without the closing line breaks (column ``value``)."""
    revisit = F.col("record_type") == "revisit"
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))
    clean_url = F.regexp_replace("url", "[\\r\\n]", "")
    head = [
        F.lit(VERSION + BREAK),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", record_id(F.col("page_id"), F.col("digest"), F.col("copy"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", clean_url),
        F.when(F.col("page_id").isNotNull(), line("WARC-Page-ID", F.col("page_id").cast("string"))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit(SAME_PAYLOAD)),
                line("WARC-Refers-To", record_id(F.col("origin"), F.col("digest"), F.lit(0))),
            ),
        ).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, "0").otherwise(F.col("bytes").cast("string"))),
        F.lit(BREAK),
        F.when(revisit, "").otherwise(F.col("payload")),
    ]
    return rows.select(F.concat(*head).alias("value"))


def write_archives(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    payload: str = "html",
    url: str = "url",
    least_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Writes a record per page into gzip-compressed archives below ``path``.

    Of equal payloads of ``least_bytes`` or more the smallest page id is the response and the others
    are revisits; smaller payloads are all responses.  A null payload is empty, a null url blank.  A
    null id counts as larger than any; of rows that repeat id and payload the one with the smallest
    url comes first and the others are revisits.  Other columns don't matter; an empty table writes no
    record.
    """
    rows = resolved(pages, id_column, payload, url, least_bytes)
    total = pages.select(F.sum(F.octet_length(text_of(payload)).cast("long") + 512)).first()[0] or 0
    archives = max(1, -(-total // archive_bytes))
    spread = F.pmod(F.xxhash64("page_id", "copy", "url"), F.lit(archives))
    lines = rows.withColumn("archive", spread).repartition(archives, "archive")
    records(lines, date).write.option("lineSep", BREAK * 2).option("compression", "gzip").text(path)


def parsed(archive: bytes) -> Iterator[dict[str, object]]:
    """The records of an archive: headers in lower case, and the content under ``content``."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        version, *lines = archive[at:end].decode("utf-8").split(BREAK)
        if version != VERSION:
            raise ValueError(f"no WARC record at byte {at}")
        head: dict[str, object] = {}
        for header in lines:
            name, _, value = header.partition(": ")
            head[name.lower()] = value
        size = int(str(head["content-length"]))
        head["content"] = archive[end + 4 : end + 4 + size]
        at = end + 4 + size + 4
        yield head


_READ = "page_id long, record_id string, record_type string, refers_to_id string, url string, digest string, sound boolean, content string"


def _records_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        for archive in frame["value"]:
            rows, size = [], 0
            for r in parsed(archive.encode("utf-8", "surrogatepass")):
                content, digest = r["content"], str(r["warc-payload-digest"]).removeprefix("sha1:")
                found = base64.b32encode(hashlib.sha1(content).digest()).decode()
                page = r.get("warc-page-id")
                rows.append(
                    (
                        int(page) if page is not None else None,
                        r["warc-record-id"],
                        r["warc-type"],
                        r.get("warc-refers-to"),
                        r["warc-target-uri"],
                        digest,
                        r["warc-type"] == "revisit" or found == digest,
                        content.decode("utf-8", "surrogatepass"),
                    )
                )
                size += len(content)
                if size > 4 << 20:
                    yield _frame(rows)
                    rows, size = [], 0
            if rows:
                yield _frame(rows)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in _READ.split(", ")])
    return frame.assign(page_id=frame["page_id"].astype("Int64"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; ``sound`` is false for a response whose content does not match its digest."""
    whole = spark.read.text(path, wholetext=True)
    return whole.mapInPandas(_records_of, _READ)


def with_payload_size(records: DataFrame) -> DataFrame:
    """Records with ``payload_bytes`` and ``refers_to`` (a page id): revisits take both from their response."""
    slim = records.select(
        "page_id", "record_id", "record_type", "refers_to_id", "digest", "sound", F.octet_length("content").cast("long").alias("size")
    )
    slim = settled(slim, "records")
    answers = slim.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"),
        F.col("page_id").alias("refers_to"),
        F.col("size").alias("their_size"),
        F.col("digest").alias("their_digest"),
    )
    found = slim.join(answers, "refers_to_id", "left")
    revisit = F.col("record_type") == "revisit"
    return found.select(
        "page_id",
        "record_type",
        F.col("digest").alias("payload_digest"),
        F.when(revisit, F.col("their_size")).otherwise(F.col("size")).alias("payload_bytes"),
        "refers_to",
        (F.col("sound") & F.when(revisit, F.col("digest").eqNullSafe(F.col("their_digest"))).otherwise(True)).alias("sound"),
    )
