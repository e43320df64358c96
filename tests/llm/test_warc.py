"""Archives: exact round trip, and revisits against the definition."""

from __future__ import annotations

import gzip
import hashlib
import random
from collections import defaultdict

import pytest
from llm_helpers import prose, same

from claimlink.llm import warc
from claimlink.llm.common import staging

PAGES = "page_id long, url string, html string, digest string, record_id int"


def expected(pages):
    groups = defaultdict(list)
    for i, _, html in pages:
        groups[html or ""].append(i)
    for html, ids in groups.items():
        raw = html.encode()
        digest = hashlib.sha1(raw).hexdigest()
        ids.sort(key=lambda i: (i is not None, i or 0))
        for k, i in enumerate(ids):
            last = len(raw) < 1000 or k == len(ids) - 1
            yield (i, len(raw), digest, "response" if last else "revisit",
                   None if last else ids[-1])


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(2)
    long = [prose(rng, 400) for _ in range(4)]
    rows = [(i, f"http://h/{i}", rng.choice(long)) for i in range(60)]
    rows += [
        (100, None, None), (101, "", ""), (102, "http://x/a b\r\nWARC-Type: revisit", "small"),
        (103, "http://x", "small"), (104, "é", "é" * 500), (105, "é", "é" * 500),
        (106, "u", "a" * 999), (107, "u", "a" * 999), (108, "u", "a" * 1000),
        (109, "u", "a" * 1000), (109, "u", "a" * 1000), (None, "u", long[0]), (None, "u", long[1]),
        (110, "w", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 100),
        (111, "w", "\r\n\r\n" + "x" * 2000 + "\r\n\r\n"), (112, "z", "\x00\x1a" * 600),
        (113, "big", "y" * 3_000_000), (114, "big", "y" * 3_000_000),
    ]
    return rows


def frame(session, pages):
    return session.createDataFrame([(*p, "clash", 1) for p in pages], PAGES).repartition(3)


def test_revisits(session, pages):
    result = warc.deduplicate_pages(frame(session, pages))
    same(result, expected(pages))
    assert result.filter("record_type = 'revisit'").count() > 50


def test_archives_return_what_was_written(session, pages):
    folder = staging(session).folder + "/archive"
    warc.archive_pages(frame(session, pages), folder)
    records = warc.read_archive(session, folder, payload=True)
    same(
        records.select("page_id", "payload"),
        [(i, bytearray((h or "").encode())) for i, _, h in pages],
    )
    assert records.select("record_id").distinct().count() == len(pages)
    odd = records.filter("url LIKE '%WARC-Type%'").first()
    assert odd.url == "http://x/a%20b%20%20WARC-Type:%20revisit"


def test_repeated_payloads_are_written_once(session, pages):
    folder = staging(session).folder
    warc.archive_pages(frame(session, pages), f"{folder}/a")
    warc.resolve_revisits(session, f"{folder}/a", f"{folder}/b")
    old, new = (warc.read_archive(session, f"{folder}/{x}", payload=True) for x in "ab")
    assert old.select("record_id").intersect(new.select("record_id")).count() == 0
    long = new.filter("payload_bytes >= 1000")
    assert long.count() == long.select("digest").distinct().count()
    targets = new.filter("refers_to IS NOT NULL").select("refers_to").distinct()
    assert targets.join(new, targets.refers_to == new.record_id, "left_anti").count() == 0


def test_files_are_bounded_by_bytes(session, pages, monkeypatch):
    """Large payloads go to files with few records; nothing else changes."""
    monkeypatch.setattr(warc, "SIZE_CLASSES", ((100, 50), (1500, 3), (1 << 31, 1)))
    same(warc.deduplicate_pages(frame(session, pages)), expected(pages))
    folder = staging(session).folder
    warc.archive_pages(frame(session, pages), folder)
    for part, most in (("size-0", 50), ("size-1", 3), ("size-2", 1)):
        files = session.read.format("binaryFile").load(f"{folder}/{part}").collect()
        counts = [len(list(warc.parse_archive(f.content))) for f in files]
        assert sum(counts) > 0 and max(counts) <= most


def test_pages_of_a_megabyte(session):
    """600 MB of pages: no file holds more than 256 MB of them."""
    assert all(size * n <= 256 << 20 for size, n in warc.SIZE_CLASSES[:-1])
    big = session.range(60).selectExpr(
        "id AS page_id", "concat('http://h/', id) AS url",
        "repeat(concat('page ', id % 40, ' '), 150000) AS html",
    )
    result = warc.deduplicate_pages(big)
    assert result.filter("payload_bytes > 1000000").count() == 60
    assert result.filter("record_type = 'revisit'").count() == 20


def test_no_pages(session):
    assert warc.deduplicate_pages(frame(session, []).limit(0)).collect() == []


def test_parser_reads_members_and_finds_damage():
    record = b"WARC/1.1\r\nContent-Length: 8\r\n\r\nH\r\n\r\nabc\r\n\r\n"
    twice = gzip.compress(record) + gzip.compress(record + record)
    assert [p for _, p in warc.parse_archive(twice)] == [b"abc"] * 3
    for bad in (record[:-6], b"HTTP" + record, record.replace(b"8", b"7")):
        with pytest.raises(ValueError):
            list(warc.parse_archive(gzip.compress(bad)))
