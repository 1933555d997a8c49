from __future__ import annotations

import base64
import glob
import gzip
import hashlib
from collections import defaultdict

import pytest

from landflow.llm import warc
from tests.llm.conftest import answers, in_order

PAGES = [
    (3, "http://a", "<p>one</p>"),
    (1, "http://b", "<p>one</p>"),
    (2, None, ""),
    (4, "http://c", None),
    (5, "http://d", "a\r\n\r\nWARC/1.1\r\nContent-Length: 7\r\n\r\nélan \U0001f600\r\n\r\n"),
    (6, "http://e\r\nX: y", "x" * 300_000),
    (7, "http://e", "x" * 300_000),
    (8, "http://f", "tiny"),
    (9, "http://g", "tiny"),
    (None, "http://h", "<p>one</p>"),
    (None, "http://i", "only here"),
    (None, "http://j", "only here"),
    (1, "http://b", "<p>one</p>"),
    (1, "http://b", "another payload"),
    *[(k, f"http://{k}", "a large group of copies") for k in range(20, 80)],
]


@pytest.fixture(scope="module")
def pages(spark):
    full = [(i, u, h, "clash", 1) for i, u, h in PAGES]
    return spark.createDataFrame(full, "page_id long, url string, html string, digest string, bytes int").repartition(4)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(least):
    first = defaultdict(list)
    for i, u, h in PAGES:
        first[h or ""].append((i is None, i, u or ""))
    out = []
    for h, members in first.items():
        members.sort(key=lambda m: (m[0], m[1] or 0, m[2]))
        for n, (_, i, _) in enumerate(members):
            revisit = n > 0 and len(h.encode()) >= least
            out.append((i, len(h.encode()), digest(h), "revisit" if revisit else "response", members[0][1] if revisit else None))
    return in_order(out)


@pytest.mark.parametrize("least", [0, 10])
def test_archives_round_trip(spark, tmp_path, pages, least):
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path, least_bytes=least, archive_bytes=100_000)
    found = warc.with_payload_size(warc.read_archives(spark, path))
    assert found.where("not sound").count() == 0
    assert answers(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == brute(least)
    assert len(glob.glob(f"{path}/*.gz")) > 1


def test_records_are_plain_warc(spark, tmp_path, pages):
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path)
    data = b"".join(gzip.open(f).read() for f in glob.glob(f"{path}/*.gz"))
    records = list(warc.parsed(data))
    assert len(records) == len(PAGES)
    assert len({r["warc-record-id"] for r in records}) == len(PAGES)
    for r in records:
        if r["warc-type"] == "revisit":
            assert r["content"] == b"" and r["warc-profile"] == warc.SAME_PAYLOAD
            assert r["warc-refers-to"] in {x["warc-record-id"] for x in records if x["warc-type"] == "response"}


def test_a_damaged_payload_is_not_sound(spark, tmp_path, pages):
    path = tmp_path / "archives"
    warc.write_archives(pages.where("page_id = 8"), str(path))
    (file,) = glob.glob(f"{path}/*.gz")
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "a.txt.gz").write_bytes(gzip.compress(gzip.open(file).read().replace(b"tiny", b"tony")))
    assert [r["sound"] for r in warc.with_payload_size(warc.read_archives(spark, str(broken))).collect()] == [False]


def test_no_pages(spark, tmp_path, pages):
    path = str(tmp_path / "archives")
    warc.write_archives(pages.where("false"), path)
    assert warc.with_payload_size(warc.read_archives(spark, path)).collect() == []
