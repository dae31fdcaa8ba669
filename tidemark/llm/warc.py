"""WARC archives packed in ZIP files: writing, and reading records by ranges without extraction.

An archive is a ZIP file with two stored members: ``archive/data.warc`` with the records, and
``indexes/index.cdxj`` with a line per record (its offset and length in the member). The reader takes the tail
of the file, finds the end record (and the ZIP64 locator and record if there are any), parses the central directory,
looks up where the stored members begin, reads the index, and then reads runs of neighbouring
records by ranges. Nothing is unpacked, and nothing but the directory is read whole.

Of pages with equal payloads (SHA-1 and length) the smallest page_id is the response, the others are revisits that
refer to it and carry no payload. Keys with over a thousandth of all pages are joined by broadcast.

Defined cases: a null html is an empty payload; a null url has no target line; rows that repeat the smallest page_id
of a payload are each a response; rows with a null page_id are revisits if a page with an id has their payload, else
responses; an empty table gives no archives and no rows; other columns are ignored.

Archives are written to the shared folder under a new name for each attempt; only names returned by finished tasks are read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_hot, saved, tasks
from tidemark.llm.token_files import file_system
from tidemark.session import work_dir

DATA, INDEX = "archive/data.warc", "indexes/index.cdxj"
#: Signatures and sizes of the ZIP format.
END, END64_AT, END64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WHEN = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, first: int | None, when: str = WHEN) -> bytes:
    """One WARC record; a revisit of page ``first`` if that is given."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if first is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Date: {when}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if first is not None:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{first}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower case) and block of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record here")
    headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return headers, rest[: int(headers["content-length"])]


class ZipReader:
    """Stored members of a ZIP file that is read by ranges: ``read_at(offset, length)``."""

    def __init__(self, read_at, size: int) -> None:
        self.read_at = read_at
        tail_at = max(0, size - (1 << 16) - 22 - 20)
        tail = read_at(tail_at, size - tail_at)
        at = tail.rfind(END)
        while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
            at = tail.rfind(END, 0, at)
        if at < 0:
            raise ValueError("no ZIP end record")
        count, length, start = struct.unpack_from("<HII", tail, at + 10)
        if at >= 20 and tail[at - 20 : at - 16] == END64_AT:
            (end64,) = struct.unpack_from("<Q", tail, at - 12)
            raw = read_at(end64, 56)
            if raw[:4] != END64:
                raise ValueError("the ZIP64 locator points nowhere")
            count, length, start = struct.unpack_from("<QQQ", raw, 32)
        self.members: dict[str, tuple[int, int]] = {}
        directory, p = read_at(start, length), 0
        for _ in range(count):
            if directory[p : p + 4] != ENTRY:
                raise ValueError("the central directory is damaged")
            method, _, _, _, packed, plain, name, extra, note = struct.unpack_from("<HHHIIIHHH", directory, p + 10)
            (header,) = struct.unpack_from("<I", directory, p + 42)
            own = directory[p + 46 : p + 46 + name].decode()
            packed, plain, header = self._wide(directory[p + 46 + name : p + 46 + name + extra], packed, plain, header)
            if method == 0 and packed == plain:
                self.members[own] = (header, plain)
            p += 46 + name + extra + note

    @staticmethod
    def _wide(extra: bytes, packed: int, plain: int, header: int) -> tuple[int, int, int]:
        """The values with those of the ZIP64 extra field, which has the overflown ones in order."""
        p, most = 0, 0xFFFFFFFF
        while p + 4 <= len(extra):
            kind, length = struct.unpack_from("<HH", extra, p)
            if kind == 1:
                values = iter(struct.unpack_from(f"<{length // 8}Q", extra, p + 4))
                plain = next(values) if plain == most else plain
                packed = next(values) if packed == most else packed
                header = next(values) if header == most else header
            p += 4 + length
        return packed, plain, header

    def where(self, member: str) -> tuple[int, int]:
        """Offset and length of a stored member's bytes."""
        header, length = self.members[member]
        local = self.read_at(header, 30)
        if local[:4] != LOCAL:
            raise ValueError(f"no local header of {member}")
        name, extra = struct.unpack_from("<HH", local, 26)
        return header + 30 + name + extra, length


def read_records(read_at, size: int, run: int = 4 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """All records of an archive, by its index; neighbours are read together, up to ``run`` bytes."""
    reader = ZipReader(read_at, size)
    start, length = reader.where(INDEX)
    base, _ = reader.where(DATA)
    entries = [json.loads(line) for line in read_at(start, length).splitlines()]
    k = 0
    while k < len(entries):
        lo = hi = entries[k]["offset"]
        first = k
        while k < len(entries) and entries[k]["offset"] == hi and (k == first or hi + entries[k]["length"] - lo <= run):
            hi += entries[k]["length"]
            k += 1
        raw = memoryview(read_at(base + lo, hi - lo))
        for e in entries[first:k]:
            yield parse(bytes(raw[e["offset"] - lo : e["offset"] - lo + e["length"]]))


def build(records: list[tuple[str, bytes]]) -> bytes:
    """A ZIP archive of (page, record) pairs."""
    out, at, lines = io.BytesIO(), 0, []
    for page, raw in records:
        lines.append(json.dumps({"page": page, "offset": at, "length": len(raw)}))
        at += len(raw)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        with z.open(zipfile.ZipInfo(DATA), "w", force_zip64=2 * at > zipfile.ZIP64_LIMIT) as f:
            for _, raw in records:
                f.write(raw)
        z.writestr(zipfile.ZipInfo(INDEX), "\n".join(lines))
    return out.getvalue()


def pages_of(pages: DataFrame) -> DataFrame:
    return pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"),
    )


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = 32 << 20) -> DataFrame:
    """Writes the archives and returns (path, records)."""
    rows = pages_of(pages).withColumn("key", F.concat_ws("-", F.sha1(F.col("html").cast("binary")), F.octet_length("html")))
    firsts = rows.groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    more = saved(firsts.filter("copies > 1"), "warc-firsts")
    total = rows.count()
    dealt = join_hot(rows, more, "key", "copies", total).select("page_id", "url", "html", "first")
    fs, root = file_system(folder)
    fs.create_dir(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total, made = [], 0, []

        def flush() -> None:
            nonlocal total
            if held:
                path = f"{folder}/{uuid.uuid4().hex}.warc.zip"
                out, name = file_system(path)
                with out.open_output_stream(name) as f:
                    f.write(build(held))
                made.append((path, len(held)))
                held.clear()
            total = 0

        for batch in batches:
            for page, url, html, first in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html", "first"))):
                raw = record(page, url, html.encode(), None if first is None or first == page else first)
                if total + len(raw) > archive_bytes:
                    flush()
                held.append((str(page), raw))
                total += len(raw)
        flush()
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], ["path", "records"]
        )

    return saved(dealt.mapInArrow(run, "path string, records long"), "warc-list")


def read_archives(files: DataFrame, with_payload: bool = False) -> DataFrame:
    """A row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to (and payload)."""
    kinds = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def number(urn: str | None) -> int | None:
        text = (urn or "").strip("<>").rpartition(":")[2]
        return int(text) if text else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                fs, name = file_system(path)
                rows = []
                with fs.open_input_file(name) as f:
                    for head, block in read_records(lambda at, n: f.read_at(n, at), f.size()):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = next(int(x[15:]) for x in http.split(b"\r\n") if x[:15].lower() == b"content-length:")
                        mark, kind = head["warc-payload-digest"].removeprefix("sha1:"), head["warc-type"]
                        if kind == "response" and (length != len(payload) or digest(payload) != mark):
                            raise ValueError(f"a payload of {path} is damaged")
                        row = (number(head["warc-record-id"]), head.get("warc-target-uri"), length, mark, kind, number(head.get("warc-refers-to")))
                        rows.append((*row, payload if kind == "response" else None) if with_payload else row)
                types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                names = [*(c.split()[0] for c in kinds.split(", ")), "payload"]
                n = len(names) - (not with_payload)
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], types[k]) for k in range(n)], names[:n])

    schema = kinds + (", payload binary" if with_payload else "")
    return files.repartition(tasks(files.sparkSession), "path").mapInArrow(run, schema)


def op7_warc(spark, sf: str) -> DataFrame:
    """Writes all pages as archives and reads them back."""
    files = write_archives(spark.read.parquet(f"{sf}/pages.parquet"), work_dir(spark, "warc"))
    return read_archives(files).drop("url")
