import base64
import hashlib
import struct

import pytest
import zstandard

from tailframe.llm import warc

PAGES = "page_id long, url string, html string, payload string"


def read_back(spark, rows, **how):
    pages = spark.createDataFrame([(*r, "clash") for r in rows], PAGES)
    return warc.read_warc(spark, warc.write_warc(pages, **how)).collect()


def test_round_trip_of_odd_pages(spark):
    rows = [(1, "http://a/\r\nX: y", "é" * 100_000), (2, None, None), (3, "http://ü/?q= x", ""), (4, "u", "\r\n\r\nWARC/1.1\r\n"), (None, "n", "alone"), (5, "http://a/", "é" * 100_000)]
    got = {r.page_id: r for r in read_back(spark, rows)}
    assert len(got) == len(rows)
    for i, url, html in rows:
        data, r = (html or "").encode(), got[i]
        assert (r.payload_bytes, r.payload_digest, r.url) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), url or "")
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == data
    kinds = {i: (r.record_type, r.refers_to) for i, r in got.items()}
    assert kinds == {1: ("revisit", 5), 2: ("revisit", 3), 3: ("response", None), 4: ("response", None), None: ("response", None), 5: ("response", None)}


def test_small_payloads_can_all_be_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc"), (4, "u", "abc")]
    assert sorted((r.page_id, r.record_type) for r in read_back(spark, rows, min_bytes=3)) == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response"), (4, "response")]


def test_empty_table(spark):
    assert warc.read_warc(spark, warc.write_warc(spark.createDataFrame([], PAGES))).count() == 0


def test_archive_layout(spark, tmp_path):
    pages = spark.range(500).selectExpr("id as page_id", "concat('http://x/', id) as url", "repeat(concat('<p>line ', id, '</p>'), 20) as html").coalesce(1)
    manifest = warc.write_warc(pages, str(tmp_path / "out")).collect()
    assert [m.n_records for m in manifest] == [500]
    data = open(manifest[0].path, "rb").read()
    assert len(data) == manifest[0].n_bytes
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.DICT_MAGIC
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
    first = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
    assert warc.parse_record(first.decompress(data[8 + size :]))["record_type"] == "response" and first.unused_data


@pytest.mark.parametrize(
    ("old", "new"),
    [(b"WARC/1.1", b"HTTP/1.1"), (b"<p>a", b"<p>b"), (b"WARC-Date", b"X-Date"), (b"Content-Length: ", b"Content-Length: 1"), (b"WARC-Payload-Length: 9", b"WARC-Payload-Length: 8"), (b"WARC-Type: response", b"WARC-Type: metadata"), (b"WARC-Date:", b"WARC-Type:")],
)
def test_damaged_records_are_refused(old, new):
    payload = b"<p>a</p>\n"
    record = warc._record(1, "u", payload, hashlib.sha1(payload).hexdigest(), None, "2024-01-01T00:00:00Z")
    assert bytes(warc.parse_record(record)["payload"]) == payload
    with pytest.raises(warc.WarcError):
        warc.parse_record(record.replace(old, new, 1))


def test_cut_archives_are_refused(tmp_path):
    import pyarrow as pa

    frame = zstandard.ZstdCompressor().compress(b"x" * 1000)
    for data in (frame[:-3], frame + b"junk", struct.pack("<II", warc.DICT_MAGIC, 100) + b"short"):
        with pytest.raises((warc.WarcError, zstandard.ZstdError)):
            list(warc._frames(pa.BufferReader(data)))
    assert list(warc._frames(pa.BufferReader(frame + frame))) == [b"x" * 1000] * 2
