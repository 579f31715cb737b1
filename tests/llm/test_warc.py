"""Archives: monolithic files, normalising, revisits, reading by index."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib

import pytest

from rooftally.llm import storage, warc

PAGES = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/", "<p>two</p>"), (3, "http://c/", "<p>one</p>"), (4, None, None), (5, "http://e/", ""), (None, "http://f/", "<p>two</p>"),
    (6, "http://g/\r\nX: y", "é\r\n\r\nWARC/1.1\r\n" * 40), (7, "http://h/", "x" * 400_000), (3, "http://c/", "<p>one</p>"), (8, "http://i/", "alone"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id bigint, url string, html string").repartition(2)


def test_round_trip(pages):
    got = warc.round_trip(pages).collect()
    assert len(got) == len(PAGES)
    top = {}
    for key, _, html in PAGES:
        top[html or ""] = max(key or -1, top.get(html or "", -1))
    html_of = {key: html or "" for key, _, html in PAGES}
    responses = {}
    for row in got:
        html = html_of[row.page_id]
        raw = html.encode()
        assert row.payload_bytes == len(raw)
        assert row.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        if row.record_type == "response":
            assert row.html == html and row.refers_to is None and row.page_id == top[html]
            responses[html] = responses.get(html, 0) + 1
        else:
            assert row.record_type == "revisit" and row.html is None and row.refers_to == top[html]
    assert responses == {html: 1 for html in top}


def test_small_payloads_are_all_responses(pages):
    kinds = {}
    for row in warc.round_trip(pages, least_bytes=10).collect():
        kinds.setdefault(row.payload_bytes, set()).add(row.record_type)
    assert kinds[0] == {"response"} and kinds[10] == {"response", "revisit"}


def test_each_record_is_a_member(pages):
    made = warc.archive(pages).collect()
    for row in made:
        with storage.stream(row.path) as file:
            raw = file.read()
        with storage.stream(row.sidecar) as file:
            entries = [line.split("\t") for line in file.read().decode().splitlines()]
        assert sum(int(length) for _, length, _, _ in entries) == len(raw) and len(entries) == row.records
        for offset, length, kind, number in entries:
            inflate = zlib.decompressobj(31)
            text = inflate.decompress(raw[int(offset):int(offset) + int(length)])
            assert inflate.eof and not inflate.unused_data
            assert text.startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode()) and number.encode() in text
        assert gzip.decompress(raw).count(b"\r\nWARC-Record-ID: ") == len(entries)


def test_monolithic_is_one_stream(pages, tmp_path):
    written = warc.write_monolithic(pages, f"file://{tmp_path}").collect()
    for path in {row.path for row in written}:
        with storage.stream(path) as file:
            inflate = zlib.decompressobj(31)
            inflate.decompress(file.read())
        assert inflate.eof and not inflate.unused_data


def test_cut_archive_is_an_error():
    raw = gzip.compress(warc.record("response", "x", {}, warc.http_block(b"payload")))
    assert [block for _, block in warc.records(io.BytesIO(raw + raw))] == [warc.http_block(b"payload")] * 2
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(gzip.compress(gzip.decompress(raw)[:-20]))))


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_inflating_holds_one_piece_at_a_time(monkeypatch):
    payloads = [b"", b"a" * (3 << 24), b"end"]
    raw = b"".join(warc.record("response", str(at), {}, warc.http_block(payload)) for at, payload in enumerate(payloads))
    whole = gzip.compress(raw)
    assert len(whole) < 1 << 17
    for file in (whole, gzip.compress(raw[:100]) + gzip.compress(raw[100:])):
        assert max(map(len, warc.inflated(io.BytesIO(file)))) <= 1 << 22
        assert b"".join(warc.inflated(io.BytesIO(file))) == raw
        assert [block for _, block in warc.records(io.BytesIO(file))] == [warc.http_block(payload) for payload in payloads]
    # Pieces and reads that end anywhere.
    monkeypatch.setattr(warc, "_READ", 7)
    monkeypatch.setattr(warc, "_PIECE", 11)
    small = b"".join(warc.record("response", str(at), {}, warc.http_block(b"ab" * at)) for at in range(20))
    assert [len(block) for _, block in warc.records(io.BytesIO(gzip.compress(small)))] == [len(warc.http_block(b"ab" * at)) for at in range(20)]
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(gzip.compress(small[:-50]))))


def test_empty_and_clashing_tables(spark, pages, clashing):
    assert warc.round_trip(pages.where("false")).count() == 0
    names = ("page_id", "record_type", "payload_bytes", "refers_to", "html")

    def plain(df):
        return sorted((tuple(row) for row in warc.round_trip(df).select(*names).collect()), key=repr)

    assert plain(clashing(pages)) == plain(pages)
