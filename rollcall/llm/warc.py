"""WARC archives: a writer with revisit records, and a sequential reader.

The writer makes one gzip member per record. The reader goes through an archive once, from
front to back: it inflates a member piece by piece, takes the record's head, frames the block by
``Content-Length``, and checks the digest of the payload while it passes by. Neither holds more
than a piece of a file, and one record, in memory.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, written

#: Payloads shorter than this are always stored.
MIN_REVISIT_BYTES = 1000
#: Copies of the list of repeated payloads, so that one payload's pages meet in many tasks.
SALTS = 32
PIECE = 1 << 16
CRLF = b"\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a URI or a plain path."""
    return fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, kind: str
) -> bytes:
    """One WARC/1.1 record, not compressed. The block is an HTTP answer; a revisit has its head only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url) if url else "urn:page"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if kind == "revisit":
        lines += [
            f"WARC-Profile: {SAME_PAYLOAD}",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"Refers-To-Page-ID: {refers_to}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return CRLF.join(x.encode() for x in lines) + CRLF * 2 + block + CRLF * 2


def with_record_types(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` with ``digest``, ``record_type`` and ``refers_to``.

    Of rows with equal payloads of ``MIN_REVISIT_BYTES`` bytes or more, those with the largest
    page_id are responses (a repeated row twice), the others revisits of it. Rows without
    page_id come last; a payload that only such rows hold is a response each time. Only digests
    that occur more than once travel to the pages, ``SALTS`` times each, and the pages meet
    them by digest and salt.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(
        "page_id", "url", "html", F.sha1(payload).alias("digest"),
        F.octet_length(payload).alias("n"),
        F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).alias("salt"),
    )
    repeated = (
        rows.filter(F.col("n") >= MIN_REVISIT_BYTES)
        .groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("c"))
        .filter("c > 1 and response is not null")
        .select("digest", "response", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
        .select("digest", "response", F.col("s").cast("long").alias("salt"))
    )
    again = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return rows.join(written(repeated, "warc-repeated"), ["digest", "salt"], "left").select(
        "page_id", "url", "html", "digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("response")).alias("refers_to"),
    )


def write_warc(pages: DataFrame, folder: str) -> DataFrame:
    """Write every page as a record below ``folder``; return (path, records, bytes) per archive.

    Each attempt of a task writes a file under a name of its own and names it in its result, so
    files of lost attempts are never read. Read only what the returned table lists.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, n, size = None, "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    store, inner = open_store(path)
                    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                    out = store.open_output_stream(inner, compression=None)
                data = (row["html"] or "").encode()
                member = zlib.compressobj(6, zlib.DEFLATED, 31)
                body = member.compress(
                    record_bytes(
                        row["page_id"], row["url"], data, row["digest"], row["refers_to"], row["record_type"]
                    )
                ) + member.flush()
                out.write(body)
                n, size = n + 1, size + len(body)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"path": [path], "records": pa.array([n], pa.int64()), "bytes": pa.array([size], pa.int64())}
            )

    listed = with_record_types(pages).mapInArrow(write, "path string, records long, bytes long")
    return written(listed, "warc-list")


class Members:
    """Bytes of a gzip file of many members, inflated piece by piece; plain files as they are."""

    def __init__(self, stream) -> None:
        self.stream, self.pending, self.box = stream, stream.read(PIECE), None
        self.zipped = self.pending[:2] == b"\x1f\x8b"

    def piece(self) -> bytes:
        """The next bytes; b"" at the end of the file. Raises ``zlib.error`` or ``EOFError``."""
        while True:
            if not self.pending:
                self.pending = self.stream.read(PIECE)
                if not self.pending:
                    if self.box is not None:
                        raise EOFError("the last member is cut off")
                    return b""
            if not self.zipped:
                out, self.pending = self.pending, b""
                return out
            if self.box is None:
                self.box = zlib.decompressobj(31)
            out = self.box.decompress(self.pending, PIECE * 16)
            if self.box.eof:
                self.pending, self.box = self.box.unused_data, None
            else:
                self.pending = self.box.unconsumed_tail
            if out:
                return out


class Records:
    """Heads and blocks of the records of one archive, in order."""

    def __init__(self, stream) -> None:
        self.members, self.buffer, self.left = Members(stream), b"", 0

    def _more(self) -> bool:
        piece = self.members.piece()
        self.buffer += piece
        return bool(piece)

    def next_head(self) -> dict[str, str] | None:
        """Fields of the next record by lower-case name, None at the end."""
        while self.left:
            self.block()
        while True:
            self.buffer = self.buffer.lstrip(CRLF)
            if self.buffer:
                break
            if not self._more():
                return None
        while len(self.buffer) < 5 and self._more():
            pass
        if not self.buffer.startswith(b"WARC/"):
            raise ValueError("no record begins here")
        seen = 0
        while self.buffer.find(CRLF * 2, seen) < 0:
            seen = max(len(self.buffer) - 3, 0)
            if not self._more():
                raise ValueError("a record's head does not end")
        head, self.buffer = self.buffer.split(CRLF * 2, 1)
        _, *lines = head.decode("utf-8", "replace").split("\r\n")
        fields, last = {}, ""
        for line in lines:
            if line[:1] in " \t" and last:
                fields[last] += " " + line.strip()
            else:
                name, _, value = line.partition(":")
                last = name.strip().lower()
                fields[last] = value.strip()
        self.left = int(fields["content-length"])
        return fields

    def block(self) -> bytes:
        """The next bytes of the block; b"" when it is over."""
        if self.left and not self.buffer and not self._more():
            raise EOFError("a block is cut off")
        out, self.buffer = self.buffer[: self.left], self.buffer[self.left :]
        self.left -= len(out)
        return out


def read_record(records: Records, fields: dict[str, str]) -> dict:
    """What is known of the record whose head was just read; its payload passes by."""
    http = fields.get("content-type", "").startswith("application/http")
    head, found, sha, size, texts = b"", not http, hashlib.sha1(), 0, []
    while piece := records.block():
        if not found:
            head += piece
            if CRLF * 2 not in head:
                continue
            head, piece = head.split(CRLF * 2, 1)
            found = True
        sha.update(piece)
        size += len(piece)
        texts.append(piece)
    told = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields.get("warc-type")
    if kind == "revisit":
        digest, ok = told, None
        lengths = [x for x in head.split(CRLF) if x.lower().startswith(b"content-length:")]
        size = int(lengths[0].partition(b":")[2]) if lengths else None
    else:
        digest = sha.hexdigest()
        ok = digest == told.lower() if told else None
    return {
        "page_id": int(fields["page-id"]) if "page-id" in fields else None,
        "url": fields.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": int(fields["refers-to-page-id"]) if "refers-to-page-id" in fields else None,
        "digest_ok": ok,
        "payload": b"".join(texts) if kind != "revisit" else None,
        "error": None,
    }


RECORD = pa.schema([
    ("path", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("digest_ok", pa.bool_()), ("error", pa.string()),
    ("payload", pa.binary()),
])


def read_warc(spark: SparkSession, archives: DataFrame, payload: bool = True) -> DataFrame:
    """A row per record of the files in ``archives(path)``, null paths left out.

    ``digest_ok`` is false where the payload does not have the digest its head tells, null
    where there is nothing to compare. An archive that breaks off or holds something else ends
    with one row that says so in ``error``; the records before it are whole.
    """
    schema = RECORD if payload else RECORD.remove(len(RECORD) - 1)

    def one(path: str) -> Iterator[dict]:
        try:
            store, inner = open_store(path)
            with store.open_input_stream(inner, compression=None) as stream:
                records = Records(stream)
                while (fields := records.next_head()) is not None:
                    yield read_record(records, fields) | {"path": path}
        except (OSError, ValueError, KeyError, EOFError, zlib.error) as problem:
            yield dict.fromkeys(RECORD.names) | {"path": path, "error": str(problem)[:200]}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for row in one(path) if path is not None else ():
                    size += len(row["payload"] or b"") if payload else 0
                    rows.append({k: row[k] for k in schema.names})
                    if len(rows) >= 2000 or size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    kinds = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean", pa.binary(): "binary"}
    ddl = ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)
    files = archives.select("path").repartition(
        max(1, spark.sparkContext.defaultParallelism * 2), "path"
    )
    return files.mapInArrow(read, ddl)


def archive_folder(spark: SparkSession) -> str:
    return shared_folder(spark, "warc")
