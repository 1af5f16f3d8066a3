"""Operator 5, WARC archives: writer and splittable reader.

Records are gzip members of their own, so an archive can be read from any
byte: a task owns the records that start inside its byte range, finds the first
one by the gzip magic, and accepts a candidate only if it decodes to a WARC
header block whose Content-Length fits and that ends at the file's end or at
the next magic.  Payloads of at least ``min_revisit`` bytes that occur several
times are stored once; the others are ``revisit`` records.

Archives go to the shared folder of ``spark.checkpoint.dir``.  Every write
attempt has its own file names, and only files of attempts that succeeded are
in the manifest, so lost executors and retried tasks leave no double records.

Defined cases: a null payload is an empty payload; empty and short payloads are
always ``response``; rows that repeat a page id and payload are each a record,
all of them ``response`` if the id is the smallest of that payload, else all
``revisit``; a null page id never counts as smallest and reads back as null; an
empty table gives no archive and no rows; control characters in a URL are
percent-encoded; one record is held in memory at a time.
"""
from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .frames import new_folder, ship_package

MAGIC = b"\x1f\x8b\x08"
FILE_BYTES = 128 << 20
SPLIT_BYTES = 16 << 20
CHUNK = 1 << 20
MANIFEST = "path string, bytes bigint, records bigint"
RECORD = "path string, offset bigint, record_type string, page_id bigint, refers_to bigint, url string, payload_bytes bigint, payload_digest string, payload binary"
_RECORD_TYPE = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64()),
                          ("refers_to", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                          ("payload_digest", pa.string()), ("payload", pa.binary())])


def with_revisits(pages: DataFrame, folder: str, min_revisit: int) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to (the first
    page with that payload, for later ones).  Only repeated digests are joined,
    from a written table, so that Spark knows its size."""
    p = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    p = p.withColumns({"payload_bytes": F.length("payload").cast("bigint"), "payload_digest": F.sha2("payload", 256)})
    firsts = p.where(F.col("payload_bytes") >= min_revisit).groupBy("payload_digest") \
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies")).where((F.col("copies") > 1) & F.col("first_id").isNotNull())
    firsts.select("payload_digest", "first_id").write.parquet(f"{folder}/repeated")
    firsts = pages.sparkSession.read.parquet(f"{folder}/repeated")
    later = (F.col("payload_bytes") >= min_revisit) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return p.join(firsts, "payload_digest", "left") \
        .select("page_id", "url", "payload", "payload_bytes", "payload_digest", F.when(later, F.col("first_id")).alias("refers_to"))


def _uri(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url)


def encode_record(page_id, url, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    """One gzip member with a WARC/1.0 record (a revisit holds no payload)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.0", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(5, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write rows of ``with_revisits``; the manifest of the files that count."""
    ship_package(records.sparkSession)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        out, name, size, n = None, "", 0, 0
        for batch in batches:
            for page_id, url, payload, length, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{top}/{name}", compression=None)
                member = encode_record(page_id, url, payload, length, digest, refers)
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [size], "records": [n]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [size], "records": [n]})

    rows = records.select("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to")
    return reliable_checkpoint(rows.mapInArrow(task, MANIFEST))


class _Window:
    """Forward reads from an offset of a file, a chunk at a time."""

    def __init__(self, file, size: int, start: int):
        self.file, self.size, self.at, self.data = file, size, start, b""

    def fill(self) -> bool:
        left = self.size - self.at - len(self.data)
        if left <= 0:
            return False
        self.file.seek(self.at + len(self.data))
        self.data += self.file.read(min(CHUNK, left))
        return True

    def skip(self, n: int) -> None:
        self.data, self.at = self.data[n:], self.at + n


def _member(w: _Window) -> tuple[bytes, int] | None:
    """The member that starts at the window's offset, and its length; None if
    what starts there isn't a whole gzip member with a WARC header."""
    z, raw, used = zlib.decompressobj(31), [], 0
    checked = False
    while not z.eof:
        if used >= len(w.data) and not w.fill():
            return None
        try:
            piece = w.data[used:]
            raw.append(z.decompress(piece))
        except zlib.error:
            return None
        used += len(piece) - len(z.unused_data)
        if not checked and sum(map(len, raw)) >= 7:
            checked = True
            if not b"".join(raw).startswith(b"WARC/1."):
                return None
    return (b"".join(raw), used) if checked else None


def parse_record(raw: bytes) -> dict | None:
    """Header fields and payload; None unless the lengths fit."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    if not gap or not lines[0].startswith("WARC/1.") or not fields.get("content-length", "").isdigit():
        return None
    size = int(fields["content-length"])
    if len(rest) != size + 4:
        return None
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    told = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}
    return {"fields": fields, "http": told, "payload": payload}


def _page(urn: str | None) -> int | None:
    tail = (urn or "").strip("<>").rpartition(":")[2]
    return int(tail) if tail.lstrip("-").isdigit() else None


def members(file, size: int, start: int, end: int) -> Iterator[tuple[int, dict]]:
    """Offset and record of all members that start in [start, end)."""
    w, synced = _Window(file, size, start), start == 0
    while w.at < end and (len(w.data) >= 3 or w.fill() or w.data):
        if not synced:
            hit = w.data.find(MAGIC)
            if hit < 0:
                w.skip(max(0, len(w.data) - 2))
                if not w.fill():
                    return
                continue
            w.skip(hit)
            if w.at >= end:
                return
        found = _member(w)
        record = parse_record(found[0]) if found else None
        if record is not None and not synced:
            if len(w.data) < found[1] + 3:
                w.fill()
            after = w.data[found[1]: found[1] + 3]
            if after and after != MAGIC:
                record = None
        if record is None:
            if synced:
                raise ValueError(f"no WARC record at byte {w.at}")
            w.skip(1)
            continue
        synced = True
        yield w.at, record
        w.skip(found[1])


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records of the files in ``manifest`` (path, bytes), by byte ranges."""
    ship_package(manifest.sparkSession)
    ranges = manifest.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(split_bytes).cast("bigint"))).alias("start")) \
        .where(F.col("bytes") > 0)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(r["path"])
                with store.open_input_file(path) as file:
                    held, rows = 0, []
                    for offset, rec in members(file, r["bytes"], r["start"], min(r["bytes"], r["start"] + split_bytes)):
                        f, revisit = rec["fields"], rec["fields"].get("warc-type") == "revisit"
                        rows.append({"path": r["path"], "offset": offset, "record_type": f.get("warc-type"),
                                     "page_id": _page(f.get("warc-record-id")), "refers_to": _page(f.get("warc-refers-to")),
                                     "url": f.get("warc-target-uri"),
                                     "payload_bytes": int(rec["http"].get("content-length", 0)) if revisit else len(rec["payload"]),
                                     "payload_digest": f.get("warc-payload-digest", "").rpartition(":")[2] if revisit
                                     else hashlib.sha256(rec["payload"]).hexdigest(),
                                     "payload": None if revisit else rec["payload"]})
                        held += len(rec["payload"])
                        if held > 4 * CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_TYPE)
                            held, rows = 0, []
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_TYPE)

    n = max(1, ranges.count())
    return ranges.repartition(n).mapInArrow(task, RECORD) if n < 10_000 else ranges.repartition(10_000).mapInArrow(task, RECORD)


def archive(pages: DataFrame, min_revisit: int = 100, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives; the manifest."""
    folder = new_folder(pages.sparkSession, "warc")
    return write_archives(with_revisits(pages, folder, min_revisit), f"{folder}/files", file_bytes)


def round_trip(pages: DataFrame) -> DataFrame:
    return read_archives(archive(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
