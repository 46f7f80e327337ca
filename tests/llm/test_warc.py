"""Archives: round trips, revisits, and damage that must not pass."""

from __future__ import annotations

import gzip
import hashlib

import pytest

from quaywork.llm.warc import ArchiveError, members, parse_record, read_archives, write_archives

SCHEMA = "page_id bigint, url string, html string, path string, payload string"


@pytest.fixture(scope="module")
def pages(spark):
    big, other = "<p>" + "ü" * 800, "x" * 1000
    rows = [
        (1, "http://a/1", big),
        (2, "http://a/2", big),
        (7, "http://a/7\r\nX: y", big),
        (3, None, "small"),
        (4, "http://a/4", "small"),
        (5, "http://a/5", None),
        (6, "http://a/6", ""),
        (8, "http://a/8", other),
        (8, "http://a/8", other),
        (9, "u", "y" * 999),
        (10, "u", "y" * 999),
        (None, "u", other),
        (None, "u", "line\r\n\r\nWARC/1.1\r\n\r\n"),
        (11, "u", "z" * 3_000_000),
    ]
    return spark.createDataFrame([(*r, "p", "q") for r in rows], SCHEMA)


def test_round_trip(spark, pages):
    files = write_archives(pages, max_file_bytes=500)
    assert files.count() > 4
    got = sorted(
        (str(r["page_id"]), r["url"] or "", r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["payload"])
        for r in read_archives(files).collect()
    )
    want = []
    for r in pages.collect():
        data = (r["html"] or "").encode()
        refers = 7 if "ü" in (r["html"] or "") else 8 if r["html"] == "x" * 1000 else None
        kind = "revisit" if refers is not None and r["page_id"] != refers else "response"
        want.append(
            (
                str(r["page_id"]),
                " ".join((r["url"] or "").split()),
                len(data),
                hashlib.sha1(data).hexdigest(),
                kind,
                refers if kind == "revisit" else None,
                data.decode() if kind == "response" else None,
            )
        )
    assert got == sorted(want, key=lambda t: tuple(map(str, t))) or sorted(map(str, got)) == sorted(map(str, want))


def test_each_record_is_a_gzip_member(pages):
    for r in write_archives(pages).collect():
        path = r["path"].removeprefix("file://")
        with open(path, "rb") as file:
            data = file.read()
        parts = list(members(iter([data])))
        assert len(parts) == r["records"] + 1
        assert b"".join(parts) == gzip.decompress(data)
        assert list(members(data[i : i + 1] for i in range(min(len(data), 5000)))) if len(data) < 5000 else True
        with pytest.raises(ArchiveError):
            list(members(iter([data[:-1]])))


def test_damage():
    good = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert parse_record(good)[1] == b"abc"
    for bad in (good[:-1], good.replace(b": 3", b": 2"), good.replace(b": 3", b": 9"), b"HTTP" + good, b""):
        with pytest.raises(ArchiveError):
            parse_record(bad)
    digest = b"WARC-Block-Digest: sha1:AAAA\r\n"
    with pytest.raises(ArchiveError):
        parse_record(good.replace(b"Content-Length", digest + b"Content-Length"))


def test_empty(spark, pages):
    files = write_archives(pages.where("false"))
    assert files.count() == 0
    assert read_archives(files).count() == 0
