"""WARC archives: a writer with revisit records and a splittable reader.

The writer gives each record a gzip member of its own and each task its own files. The reader cuts
the files into byte ranges. A task looks for gzip magic in its range, accepts a candidate only if
its decoded start is a WARC header and the member ends well and is followed by another member or
the end of the file, and owns the records whose member starts inside its range, wherever they end.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.session import materialize, work_dir

MAGIC = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2024-01-01T00:00:00Z"
_ID = re.compile(r"<urn:x-page:(-?\d*)>")

#: Tasks of a read; with more byte ranges than this, tasks take several one after another.
MOST_TASKS = 20_000

WRITTEN = "path string, length long, records long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder or file that all executors share."""
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _head(fields: list[tuple[str, str]], first: str) -> bytes:
    return (first + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def record_member(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member: a response record with the payload, or a revisit without it. Both keep the
    HTTP header, whose Content-Length is that of the full payload."""
    http = _head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], "HTTP/1.1 200 OK")
    block = http + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", RECORD_DATE),
        ("WARC-Target-URI", quote(url or "", safe=":/?#[]@!$&'()*+,;=%~")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    record = _head([*fields, ("Content-Length", str(len(block)))], "WARC/1.1") + block + b"\r\n\r\n"
    return packer.compress(record) + packer.flush()


def write_warc(pages: DataFrame, folder: str, file_bytes: int = 256 << 20) -> DataFrame:
    """Write ``pages`` (page_id, url, html, refers_to, payload_digest) as ``*.warc.gz`` in
    ``folder`` and return the files (path, length, records). File names are unique for each task
    attempt, and only the files of successful attempts are returned."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = open_store(folder)
        store.create_dir(top, recursive=True)
        out, done = None, []
        length = records = 0

        def close() -> None:
            out.close()
            done.append((path, length, records))

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path = f"{top}/{uuid.uuid4().hex}.warc.gz"
                    out, length, records = store.open_output_stream(path, compression=None), 0, 0
                member = record_member(row["page_id"], row["url"], (row["html"] or "").encode(), row["payload_digest"], row["refers_to"])
                out.write(member)
                length, records = length + len(member), records + 1
                if length >= file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        names = [folder.rstrip("/") + "/" + path.rpartition("/")[2] for path, _, _ in done]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([x[i] for x in done], pa.int64()) for i in (1, 2))], ["path", "length", "records"])

    return materialize(pages.mapInArrow(write, WRITTEN), "warc-files")


class _Window:
    """Bytes of a file from ``start`` on, read as far as needed."""

    def __init__(self, handle, start: int, length: int, step: int = 1 << 20):
        self.handle, self.base, self.length, self.step, self.data = handle, start, length, step, bytearray()
        handle.seek(start)

    def upto(self, end: int) -> None:
        while self.base + len(self.data) < min(end, self.length):
            got = self.handle.read(max(self.step, end - self.base - len(self.data)))
            if not got:
                raise ValueError("archive is shorter than its stated length")
            self.data += got

    def drop(self, until: int) -> None:
        if until - self.base > self.step:
            del self.data[: until - self.base]
            self.base = until

    def find(self, what: bytes, start: int, end: int) -> int:
        """Place of ``what`` that starts in [start, end), or -1."""
        at = start
        while at < end:
            self.upto(min(at + self.step, end) + len(what) - 1)
            stop = min(at + self.step, end)
            hit = self.data.find(what, at - self.base, stop - self.base + len(what) - 1)
            if hit >= 0:
                return self.base + hit
            at = stop
            self.drop(at)
        return -1


def _member(window: _Window, start: int) -> tuple[bytes, int] | None:
    """Content and end of the WARC member that starts at ``start``; None if none does."""
    unpack, at, parts, probe, checked = zlib.decompressobj(31), start, [], b"", False
    try:
        while not unpack.eof:
            window.upto(at + 65536)
            piece = bytes(window.data[at - window.base : at - window.base + 65536])
            if not piece:
                return None
            got = unpack.decompress(piece)
            at += len(piece) - len(unpack.unused_data)
            parts.append(got)
            if not checked:
                probe += got
                if len(probe) >= 7 or unpack.eof:
                    if not probe.startswith(b"WARC/1."):
                        return None
                    checked = True
    except zlib.error:
        return None
    window.upto(at + len(MAGIC))
    after = bytes(window.data[at - window.base : at - window.base + len(MAGIC)])
    return (b"".join(parts), at) if after in (b"", MAGIC) else None


def _fields(head: bytes) -> dict[str, str]:
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in head.decode("utf-8").split("\r\n")[1:])}


def parse_record(record: bytes) -> tuple:
    """The values of ``RECORDS``; the digest of a response is computed and compared."""
    head, _, rest = record.partition(b"\r\n\r\n")
    warc = _fields(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    said = warc["warc-payload-digest"].removeprefix("sha1:")
    number = lambda text: int(m[1]) if (m := _ID.fullmatch(text)) and m[1] else None
    page, url = number(warc["warc-record-id"]), warc.get("warc-target-uri") or None
    if warc["warc-type"] == "revisit":
        return page, url, int(_fields(http)["content-length"]), said, "revisit", number(warc["warc-refers-to"]), None
    if (found := sha1_base32(payload)) != said:
        raise ValueError(f"payload digest of {warc['warc-record-id']} is {found}, its header says {said}")
    return page, url, len(payload), found, "response", None, payload


def records_in(uri: str, start: int, end: int, length: int) -> Iterator[tuple]:
    """The records of a file whose members start in [start, end)."""
    store, path = open_store(uri)
    with store.open_input_file(path) as handle:
        window, at = _Window(handle, start, length), start
        while (hit := window.find(MAGIC, at, end)) >= 0:
            if found := _member(window, hit):
                yield parse_record(found[0])
                at = found[1]
            else:
                at = hit + 1
            window.drop(at)


def read_warc(files: DataFrame, split_bytes: int = 8 << 20) -> DataFrame:
    """The records of archives (``files``: path, length) as ``RECORDS`` columns, read in byte
    ranges of ``split_bytes`` that tasks take independently."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("long")))
    splits = files.where("length > 0").select("path", "length", starts.alias("start"))
    n_splits = files.agg(F.sum(F.ceil(F.col("length") / split_bytes))).first()[0] or 1
    splits = splits.repartition(min(int(n_splits), MOST_TASKS), F.col("path"), F.col("start"))
    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(col), kind.type) for col, kind in zip(zip(*rows), kinds)], schema=kinds)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            for s in some.to_pylist():
                rows, held = [], 0
                for row in records_in(s["path"], s["start"], min(s["start"] + split_bytes, s["length"]), s["length"]):
                    rows.append(row)
                    held += len(row[-1] or b"") + 200
                    if held > 4 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    return splits.mapInArrow(read, RECORDS)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) plus ``payload_digest`` and ``refers_to``: null, or for a page
    whose payload of at least ``min_bytes`` has a copy with a smaller page_id, the smallest such id.

    Rows with the smallest id themselves, repeated ones too, refer to nothing. Pages with a null id
    refer to the smallest id of their payload if there is one. Digests meet in a grouped minimum
    with partial sums, and only payloads that occur twice come back, so the payloads themselves
    move once.
    """

    @F.pandas_udf("string")
    def base32(digests):
        return digests.map(lambda d: base64.b32encode(bytes.fromhex(d)).decode())

    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("_sha"))
    seen = rows.select("_sha", "page_id", F.octet_length("html").alias("_n"))
    groups = seen.where(F.col("_n") >= min_bytes).groupBy("_sha").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    joined = rows.join(groups.drop("_n"), "_sha", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return joined.select("page_id", "url", "html", base32("_sha").alias("payload_digest"), refers.alias("refers_to"))


def archive_pages(spark: SparkSession, pages: DataFrame, min_bytes: int = 0, split_bytes: int = 8 << 20) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read all records back (``RECORDS``).

    A null html is an empty payload, a null url an empty target; line breaks and other characters
    that a header cannot hold are percent-encoded in the url. An empty table writes no archive and
    reads no record. Other columns are not read.
    """
    folder = work_dir(spark, "warc")
    return read_warc(write_warc(with_revisits(pages, min_bytes), folder), split_bytes)
