from __future__ import annotations

import base64
import hashlib

import pytest

from tenderlake.llm import warc

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 4\r\n\r\nfake\r\n\r\n"
PAGES = [(i, f"http://h/{i}", f"<p>{i}</p>" + "é" * (i % 50)) for i in range(120)]
PAGES += [(500, "http://a", "same"), (501, None, "same"), (501, "http://b\r\nX: y", "same"), (None, "u", "same")]
PAGES += [(600, "u", None), (601, "u", ""), (602, "u", "x" * 200_000)]
PAGES += [(700, "u", "before " + FAKE + " after"), (701, "u", FAKE * 3), (702, "u", "WARC/1.0\r\n"),
          (703, "u", "WARC/1.0\r\nContent-Length: 99999\r\n\r\n"), (704, "u", "\r\n\r\nWARC/1.0\r\n\r\n")]


def expected(pages):
    first = {}
    for k, (page, _, html) in enumerate(pages):
        key = html or ""
        order = (page is None, page or 0, k)
        first[key] = min(first.get(key, order), order)
    out = []
    for k, (page, _, html) in enumerate(pages):
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        none, head, row = first[html or ""]
        if row == k:
            out.append((page, len(body), digest, "response", None))
        else:
            out.append((page, len(body), digest, "revisit", None if none else head))
    return out


def rows(df):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted(repr(tuple(r[n] for n in names)) for r in df.collect())


@pytest.fixture
def pages(llm):
    make = lambda data: llm.createDataFrame([(*r, 1) for r in data], "page_id long, url string, html string, digest int")
    return make


@pytest.mark.parametrize("split", ["134217728", "3000", "512"])
def test_round_trip_in_splits(llm, pages, split):
    """Whatever the splits, the chain from the start of each file finds the true records."""
    before = llm.conf.get("spark.sql.files.maxPartitionBytes")
    frame = pages(PAGES).coalesce(2)
    llm.conf.set("spark.sql.files.maxPartitionBytes", split)
    llm.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert rows(warc.archived_pages(frame)) == sorted(map(repr, expected(PAGES)))
    finally:
        llm.conf.set("spark.sql.files.maxPartitionBytes", before)
        llm.conf.unset("spark.sql.files.openCostInBytes")


def test_revisits_by_exchange_are_the_same(llm, pages, monkeypatch):
    monkeypatch.setattr(warc, "FEW", 0)
    assert rows(warc.archived_pages(pages(PAGES))) == sorted(map(repr, expected(PAGES)))


def test_small_payloads_are_all_responses(llm, pages):
    out = warc.archived_pages(pages(PAGES), least_bytes=10)
    kinds = {r["page_id"]: r["record_type"] for r in out.collect()}
    assert kinds[501] == kinds[600] == kinds[601] == "response"


def test_files_are_plain_warc(llm, pages, tmp_path):
    warc.write_archives(pages([(1, "http://a/", "héllo"), (2, "http://b/", "héllo")]).coalesce(1), str(tmp_path / "w"))
    data = b"".join(f.read_bytes() for f in sorted((tmp_path / "w").glob("part-*")))
    at, kinds = 0, []
    while at < len(data):
        assert data.startswith(b"WARC/1.0\r\n", at)
        end = data.index(b"\r\n\r\n", at) + 4
        head = dict(x.split(b": ", 1) for x in data[at:end].split(b"\r\n")[1:] if x)
        size = int(head[b"Content-Length"])
        kinds.append((head[b"WARC-Type"], data[end : end + size]))
        assert data[end + size : end + size + 4] == b"\r\n\r\n"
        at = end + size + 4
    assert kinds == [(b"response", "héllo".encode()), (b"revisit", b"")]


def test_no_pages(llm, pages):
    assert warc.archived_pages(pages([])).collect() == []


def test_pages_behind_an_aggregate(llm, pages):
    """Rows whose order differs from one reading of the plan to the next."""
    many = [(i, f"http://h/{i}", f"page {i % 40}") for i in range(800)]
    behind = pages(many * 2).groupBy("page_id").agg({"url": "max", "html": "max"})
    behind = behind.withColumnsRenamed({"max(url)": "url", "max(html)": "html"}).repartition(7)
    assert rows(warc.archived_pages(behind)) == sorted(map(repr, expected(many)))


def test_places_are_compared_within_stretches(llm, pages, monkeypatch):
    """Stretches shorter than records and splits give the same rows."""
    monkeypatch.setattr(warc, "STRETCH", 64)
    assert rows(warc.archived_pages(pages(PAGES))) == sorted(map(repr, expected(PAGES)))
