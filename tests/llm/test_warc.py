import gzip
import os
import zlib

import pytest
from pyspark.sql import Row

from stockroom.llm import warc


@pytest.fixture()
def archive(tmp_path):
    def write(members):
        path = str(tmp_path / "a.warc.gz")
        with open(path, "wb") as f:
            f.write(b"".join(members))
        return path

    return write


def response(i, payload):
    return warc.record_member(i, f"http://h/{i}", payload, warc.sha1_base32(payload), None)


@pytest.mark.parametrize("step", [1, 7, 64, 1000, 10**6])
def test_every_cut_gives_each_record_once(archive, step):
    path = archive([response(i, os.urandom(i * 40)) for i in range(12)])
    size = os.path.getsize(path)
    got = [r[0] for a in range(0, size, step) for r in warc.records_in(path, a, min(a + step, size), size)]
    assert got == list(range(12))


def test_magic_and_whole_archives_within_payloads_are_not_records(archive):
    inner = response(99, b"inner")
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored blocks keep the inner member's bytes
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(inner) + inner
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:5>\r\nWARC-Payload-Digest: sha1:{warc.sha1_base32(inner)}\r\nContent-Length: {len(block)}\r\n\r\n"
    outer = stored.compress(head.encode() + block + b"\r\n\r\n") + stored.flush()
    path = archive([response(1, b"\x1f\x8b\x08 magic"), outer, response(2, b"end")])
    size = os.path.getsize(path)
    got = [r[0] for a in range(0, size, 10) for r in warc.records_in(path, a, min(a + 10, size), size)]
    assert got == [1, 5, 2]


def test_members_are_plain_gzip_and_damage_is_found(archive):
    member = response(3, "päge".encode())
    text = gzip.decompress(member)
    assert text.startswith(b"WARC/1.1\r\n") and text.endswith("päge\r\n\r\n".encode())
    bad = gzip.compress(text.replace(b"sha1:", b"sha1:A"))
    with pytest.raises(ValueError):
        list(warc.records_in(archive([bad]), 0, len(bad), len(bad)))


def test_pages_round_trip(spark):
    rows = [Row(page_id=i, url=u, html=h, payload="clash") for i, u, h in [(4, "u", "same"), (2, "u\r\nX: y", "same"), (9, None, "same"), (5, "ü", None), (6, "", ""), (None, "u", "same"), (7, "u", "x" * 3_000_000), (2, "u", "same")]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    got = {}
    for r in warc.archive_pages(spark, pages, split_bytes=200).collect():
        got.setdefault(r.page_id, []).append((r.payload_bytes, r.record_type, r.refers_to))
    assert got == {
        2: [(4, "response", None)] * 2,
        4: [(4, "revisit", 2)],
        9: [(4, "revisit", 2)],
        None: [(4, "revisit", 2)],
        5: [(0, "response", None)],
        6: [(0, "revisit", 5)],
        7: [(3_000_000, "response", None)],
    }
    small = {r.page_id: r.record_type for r in warc.archive_pages(spark, pages.where("page_id is not null"), min_bytes=1).collect()}
    assert small[6] == "response"
    assert warc.archive_pages(spark, pages.where("false")).count() == 0
