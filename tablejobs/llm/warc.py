"""WARC archives: a writer with one gzip member per record, and a splittable reader.

Reading. An archive is dealt out as byte ranges. A task looks for the gzip magic
in its range, decodes the head of each candidate and takes the first that holds
a WARC header; from there on, members follow one another. A record belongs to
the range in which its member starts, so every record is read exactly once
wherever the ranges are cut.

Writing. Every task writes one archive under a name of its attempt, and the
names of successful attempts only are in the returned manifest: a task that is
run again leaves nothing that a reader would see.

Files are opened through pyarrow's file systems by the URI of the shared folder.

Defined results: a null payload is empty; records with equal payloads are one
response (the largest page id) and revisits of it, rows of the same page id and
payload are responses both; a row without page id revisits like any other, and
is a response where its payload has no page id; null or odd URLs are written
percent-encoded; an empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs.llm.store import partitions, read, saved
from tablejobs.llm.textbatch import slices
from tablejobs.session import scratch_path

#: Bytes of an archive in one range.
SPLIT_BYTES = 4 << 20
LEVEL = 4
_CHUNK = 256 << 10
_MAGIC = b"\x1f\x8b\x08"
_EMPTY_URN = "urn:page:"


def _open(uri: str):
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to=None) -> bytes:
    """One record: a response, or a revisit of ``refers_to`` without the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    urn = lambda x: f"<{_EMPTY_URN}{'' if x is None else quote(str(x))}>"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {urn(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
            f"WARC-Payload-Digest: sha1:{digest32(payload)}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {urn(refers_to)}"]
    block = http + (payload if refers_to is None else b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(records: DataFrame, root: str) -> DataFrame:
    """Write rows (page_id, url, html, refers_to) below ``root``; a manifest of (path, length)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        path = f"{root}/part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        fs, name = _open(path)
        out = None
        for part, _, _ in slices(batches, "html"):
            if out is None:
                fs.create_dir(name.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(name, compression=None)
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in part.columns)):
                z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                body = record(page_id, url, (html or "").encode(), refers_to)
                out.write(z.compress(body) + z.flush())
        if out is not None:
            length = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "length": pa.array([length], pa.int64())})

    manifest = records.select("page_id", "url", "html", "refers_to").mapInArrow(write, "path string, length long")
    return saved(manifest, "warc_manifest")


class Members:
    """The gzip members of a file that start in [start, end)."""

    def __init__(self, file, start: int, end: int):
        self.file, self.end = file, end
        self.at = start              # where the buffer starts in the file
        self.buffer = b""
        file.seek(start)

    def _more(self) -> bool:
        chunk = self.file.read(_CHUNK)
        self.buffer += chunk
        return bool(chunk)

    def _is_member(self, at: int) -> bool:
        """Whether a member with a WARC header starts at ``at`` of the buffer."""
        size = 256
        while True:
            while len(self.buffer) < at + size and self._more():
                pass
            try:
                head = zlib.decompressobj(31).decompress(self.buffer[at:at + size], 16)
            except zlib.error:
                return False
            if len(head) >= 5 or len(self.buffer) < at + size:
                return head.startswith(b"WARC/")
            size *= 2

    def _seek_first(self) -> bool:
        look = 0
        while True:
            found = self.buffer.find(_MAGIC, look)
            if found < 0:
                keep = max(look, len(self.buffer) - len(_MAGIC) + 1)
                self.at += keep
                self.buffer, look = self.buffer[keep:], 0
                if self.at >= self.end or not self._more():
                    return False
            elif self.at + found >= self.end:
                return False
            elif self._is_member(found):
                self.at += found
                self.buffer = self.buffer[found:]
                return True
            else:
                look = found + 1

    def __iter__(self) -> Iterator[bytes]:
        if not self._seek_first():
            return
        while self.at < self.end:
            if not self.buffer and not self._more():
                return
            z, parts, used = zlib.decompressobj(31), [], 0
            while not z.eof:
                if not self.buffer and not self._more():
                    raise ValueError("the archive ends inside a record")
                parts.append(z.decompress(self.buffer))
                used += len(self.buffer) - len(z.unused_data)
                self.buffer = z.unused_data
            self.at += used
            yield b"".join(parts)


def parse(body: bytes) -> dict:
    """Header fields, payload length and digest of one record; the digest is checked for responses."""
    head, _, rest = body.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or digest32(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    name = lambda x: None if x is None else unquote(x[1:-1].removeprefix(_EMPTY_URN)) or None
    return {"page_id": name(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": name(fields.get("WARC-Refers-To")),
            "url": unquote(fields["WARC-Target-URI"]), "payload": payload}


def byte_ranges(manifest: DataFrame, split: int = SPLIT_BYTES) -> DataFrame:
    """(path, start, end) covering every file of the manifest."""
    return manifest.filter("length > 0").select(
        "path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split).cast("long"))).alias("start")
    ).select("path", "start", (F.col("start") + split).alias("end"))


_FIELDS = {"page_id": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
           "record_type": pa.string(), "refers_to": pa.string(), "url": pa.string(), "payload": pa.binary()}


def read_archives(ranges: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """The records that start in each (path, start, end), with the named fields."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                fs, name = _open(path)
                with fs.open_input_file(name) as file:
                    rows, held = [], 0
                    for body in Members(file, start, end):
                        rows.append(parse(body))
                        held += len(body)
                        if held > _CHUNK * 8 and "payload" in fields or len(rows) >= 5000:
                            yield _rows(rows, fields)
                            rows, held = [], 0
                    if rows:
                        yield _rows(rows, fields)

    names = {"string": "string", "int64": "long", "binary": "binary"}
    schema = ", ".join(f"{f} {names[str(_FIELDS[f])]}" for f in fields)
    return ranges.select("path", "start", "end").mapInArrow(scan, schema)


def _rows(rows: list[dict], fields: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f] for r in rows], _FIELDS[f]) for f in fields], list(fields))


def deduplicated(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, html, refers_to): of equal payloads all but the largest page id
    refer to it. The largest per digest is aggregated on the map side first; a payload that
    a third of the pages share makes a skewed join partition, which Spark splits."""
    keyed = pages.select("page_id", "url", "html", F.sha2(F.coalesce(F.col("html"), F.lit("")), 256).alias("k"))
    heads = keyed.groupBy("k").agg(F.max("page_id").alias("head"))
    return keyed.join(heads, "k").select(
        "page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("head")), F.col("head")).alias("refers_to"))


def round_trip(spark: SparkSession, pages: DataFrame, split: int = SPLIT_BYTES) -> DataFrame:
    """Write all pages as archives in the shared folder and read them back by byte ranges."""
    manifest = write_archives(deduplicated(pages), scratch_path(spark, "warc"))
    ranges = byte_ranges(manifest, split).repartition(partitions(spark))
    kind = dict(pages.dtypes)["page_id"]
    rows = read_archives(ranges, ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    return rows.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))


def op3_warc(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark, read(spark, sf_dir, "pages").select("page_id", "url", "html"))


OP3_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages
), q AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS head FROM p
)
SELECT page_id, strlen(body) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (k // 4) AS INTEGER), 5) AS BIGINT)
      >> CAST(5 * (3 - k % 4) AS BIGINT)) & 31) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> head THEN head END AS refers_to
FROM q
"""
