from __future__ import annotations

import base64
import hashlib

import pytest
import zstandard

from rowtide.llm import warc
from rowtide.llm.warc import Corrupt, frames, page_columns, page_record, parse_record, read_archives, round_trip, write_archives

DATE = "2025-01-01T00:00:00Z"


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


ROWS = [
    (4, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (9, None, "<p>same</p>"), (1, "http://a/\r\nX: y", None), (3, "u", ""),
    (5, "u", "é\r\n\r\nWARC/1.1\r\n"), (6, "u", "x" * 400_000), (None, "u", "<p>same</p>"), (None, "u", "alone"), (2, "http://a/2", "<p>same</p>"),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS _payload", "2 AS _digest").repartition(2)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    got = page_columns(round_trip(pages(spark), least)).drop("archive", "offset").collect()
    want = []
    for i, _, h in ROWS:
        data = (h or "").encode()
        ids = [x for x, _, o in ROWS if (o or "").encode() == data and x is not None]
        first = min(ids) if len(data) >= least and ids and min(ids) != i else None
        want.append((i, len(data), b32(data), "response" if first is None else "revisit", first))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_payloads_come_back(spark, tmp_path):
    write_archives(pages(spark), f"file://{tmp_path}/w")
    got = read_archives(spark, f"file://{tmp_path}/w").where("record_type = 'response'").collect()
    by_id = {r.record_id: r for r in got}
    assert bytes(by_id["<urn:page:5>"].payload) == ROWS[5][2].encode()
    assert bytes(by_id["<urn:page:6>"].payload) == ROWS[6][2].encode()
    assert by_id["<urn:page:1>"].target_uri == "http://a/%0D%0AX: y"
    assert by_id["<urn:page:2>"].date == DATE


def test_empty(spark):
    assert round_trip(pages(spark, ROWS[:1]).limit(0)).collect() == []


def test_archives_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)  # read in the driver only: the plan carries the function, not the number
    writer = warc._archives(b"", DATE)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"a": list(range(50)), "b": ["u"] * 50, "c": [b"x" * 3000] * 50, "d": pa.array([None] * 50, pa.int64())})
    archives = [bytes(b.column(0)[0].as_py()) for b in writer(iter([batch]))]
    assert len(archives) > 5
    assert sum(1 for a in archives for _, r in frames(a) if b"response" in r) == 50


def archive(dictionary=b"", packed=False):
    samples = [page_record(i, f"http://h/{i}", b"<html><body><p>word %d of the common text</p>" % i * 20, None, DATE) for i in range(300)]
    data = zstandard.train_dictionary(4096, samples) if dictionary is None else None
    out = b""
    if data is not None:
        held = data.as_bytes()
        out = warc.skippable(warc.DICTIONARY_MAGIC, zstandard.compress(held) if packed else held)
    frame = zstandard.ZstdCompressor(dict_data=data, write_checksum=True).compress
    return out + b"".join(frame(s) + warc.EMPTY_FRAME.encode() for s in samples), samples


@pytest.mark.parametrize("packed", [False, True])
def test_dictionary_in_leading_frame(packed):
    data, samples = archive(None, packed)
    assert [r for _, r in frames(data)] == samples
    with pytest.raises(Corrupt, match="dictionary"):
        list(frames(data[8 + int.from_bytes(data[4:8], "little") :]))


def test_broken_archives():
    data, samples = archive()
    assert [r for _, r in frames(data)] == samples
    for broken in (data[:-20], data[:50], data[:100] + b"\xff" + data[101:], b"junk" + data, data + b"PK"):
        with pytest.raises(Corrupt):
            list(frames(broken))


def test_broken_records():
    good = page_record(1, "http://a", b"<p>hi</p>", None, DATE)
    assert parse_record(good, 0)[0] == "response"
    for old, new in (
        (b"WARC/1.1", b"WARC/9.9"), (b"<p>hi</p>", b"<p>ho</p>"), (b"<p>hi</p>", b"<p>hi"), (b"WARC-Record-ID: <urn:page:1>\r\n", b""),
        (b"Content-Length: ", b"Content-Length: x"), (b"WARC-Date:", b"WARC-Date"), (b"HTTP/1.1", b"FTP"),
    ):
        with pytest.raises(Corrupt):
            parse_record(good.replace(old, new, 1), 0)
    revisit = page_record(2, None, b"<p>hi</p>", 1, DATE)
    assert parse_record(revisit, 0)[5] == "<urn:page:1>" and parse_record(revisit, 0)[7] == 9
    with pytest.raises(Corrupt):
        parse_record(revisit.replace(b"WARC-Refers-To", b"X-Refers"), 0)


def test_dictionary_of_few_pages(spark):
    """Too few to be trained on: the sample itself is the dictionary, and archives are read with it."""
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>page {i} of a few</p>" * 3) for i in range(5)], "page_id long, url string, html string")
    payloads = pages.selectExpr("page_id", "encode(html, 'UTF-8') AS _payload")
    held = warc.train_dictionary(payloads)
    assert b"of a few" in held and warc.train_dictionary(payloads.limit(0)) == b""
    assert len(warc.train_dictionary(payloads.unionAll(payloads))) == len(held)
    got = page_columns(round_trip(pages)).collect()
    assert sorted(r.page_id for r in got) == list(range(5))
