import hashlib
import zlib

import pytest

from emberledger.llm import warc as W
from emberledger.llm.common import scratch


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")


def test_round_trip_with_revisits_and_segments(spark):
    big, mid = "<p>é日" * 9000, "x" * 100
    rows = [
        (5, "http://a/?q=\r\nX: y", big), (3, None, big), (9, "http://b", big), (4, "u", None), (6, "u", ""), (7, "u", mid),
        (7, "u", mid), (8, "u", "x" * 99), (1, "u", "x" * 99), (None, "u", mid), (11, "u", "\r\n\r\n0\r\n\r\nWARC/1.1\r\n"), (12, "u", "a\x00b"),
    ]
    out = W.page_records(pages_of(spark, rows), scratch(spark, "warc")).collect()
    got = sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out)
    want = []
    for k, (page, _, html) in enumerate(rows):
        data = (html or "").encode()
        same = [(p is None, p or 0, i) for i, (p, _, h) in enumerate(rows) if (h or "").encode() == data]
        first = min(same)
        revisit = len(data) >= 100 and first[2] != k
        want.append((page is None, page or 0, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", rows[first[2]][0] if revisit else None))
    assert got == sorted(want) and all(r.error is None for r in out)


def test_empty_table(spark):
    assert W.page_records(pages_of(spark, []), scratch(spark, "warc")).count() == 0


def test_segments_are_written_and_out_of_order_files_read(spark):
    path = scratch(spark, "warc")
    W.write_archives(pages_of(spark, [(1, "u", "z" * 50_000)]), path, segment_bytes=7000, records_per_file=1)
    seg = W.read_records(spark, path, True).orderBy("segment").collect()
    assert len(seg) == 8 and len({r.file for r in seg}) == 8
    assert {r.origin_id for r in seg} == {seg[0].record_id} and seg[-1].total == sum(len(r.body) for r in seg)
    row = W.read_archives(spark, path).collect()[0]
    assert bytes(row.payload) == b"z" * 50_000 and row.error is None


@pytest.mark.parametrize("harm", ["missing", "length", "chunk", "digest"])
def test_damage_is_reported(spark, tmp_path, harm):
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4;x=1\r\nWiki\r\n5\r\npedia\r\n0\r\nTrailer: t\r\n\r\n"
    digest = hashlib.sha256(b"Wikipedia").hexdigest()
    if harm == "chunk":
        block = block.replace(b"Wiki\r\n", b"Wikis\r\n")
    if harm == "digest":
        digest = "0" * 64
    total = len(block) + (harm == "length")
    cut = [block[:20], block[20:50], block[50:]]
    data = b""
    for n, part in enumerate(cut, 1):
        if harm == "missing" and n == 2:
            continue
        head = f"WARC/1.1\r\nWARC-Type: {'response' if n == 1 else 'continuation'}\r\nWARC-Record-ID: <r{n}>\r\nWARC-Segment-Number: {n}\r\n"
        head += f"WARC-Payload-Digest: sha256:{digest}\r\nPage-Id: 1\r\n" if n == 1 else "WARC-Segment-Origin-ID: <r1>\r\n"
        head += f"WARC-Segment-Total-Length: {total}\r\n" if n == 3 else ""
        data += f"{head}Content-Length: {len(part)}\r\n\r\n".encode() + part + b"\r\n\r\n"
    gz = zlib.compressobj(wbits=31)
    (tmp_path / "a.gz").write_bytes(gz.compress(data) + gz.flush())
    row = W.read_archives(spark, f"file:{tmp_path}").collect()[0]
    assert row.payload is None and row.error


def test_trailers_and_extensions():
    assert W.dechunk(b"4;x=1\r\nWiki\r\n5\r\npedia\r\n0\r\nTrailer: t\r\n\r\n") == b"Wikipedia"
