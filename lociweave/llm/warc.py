"""WARC archives: write one gzip member per record, read them back in sequence.

Writing: each task appends its records to archive files of a bounded size in
the shared folder and returns a manifest row per finished file; files of failed
attempts are never listed. Reading: each archive is streamed in pieces through
an incremental inflater that starts anew at every member; header lines are
parsed, the block is framed by Content-Length, and both digests are verified.
Of records with equal payloads one is the response, others are revisits.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import uuid

from lociweave.llm.common import body, col, slices, table
from lociweave.session import materialize, scratch_folder

#: Payloads below this many bytes are never revisits.
MIN_REVISIT_BYTES = 100
#: An archive file is closed at this size; one longer record may exceed it.
ARCHIVE_BYTES = 16 << 20
READ_BYTES = 256 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITTEN_AT = "2000-01-01T00:00:00Z"


def classified(pages: DataFrame, page_id: str = "page_id", html: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Columns page_id, payload, digest, record_type, refers_to.

    Payload digests are shuffled, payloads are not grouped. All rows with the
    smallest page id of a payload are responses; a row without an id is a
    revisit if another row has the payload and an id.
    """
    rows = pages.select(col(page_id).alias("page_id"), body(html).alias("payload")).withColumn("digest", F.sha2("payload", 256))
    long = F.length("payload") >= min_bytes
    first = rows.filter(long).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1 and first_id is not null")
    joined = rows.join(first.select("digest", "first_id"), "digest", "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "payload", "digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first_id")).alias("refers_to")
    )


def record_id(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def record(page, payload: bytes, digest: str, kind: str, refers) -> bytes:
    """One WARC record as a gzip member of its own."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {WRITTEN_AT}",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head += [f"WARC-Refers-To: {record_id(refers)}", f"WARC-Profile: {PROFILE}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows of ``classified``; returns the manifest (``path``, ``n_records``), itself written.

    Files get random names, so a repeated attempt of a task never touches those
    of another; only what successful attempts return is listed.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name, size, n = None, "", 0, 0

        def listed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [name], "n_records": [n]})

        for batch in batches:
            for part in slices(batch, "payload"):
                for r in part.to_pylist():
                    if out is None:
                        name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    data = record(r["page_id"], r["payload"], r["digest"], r["record_type"], r["refers_to"])
                    out.write(data)
                    size, n = size + len(data), n + 1
                    if size >= archive_bytes:
                        yield listed()
                        out = None
        if out is not None:
            yield listed()

    return materialize(rows.mapInArrow(write, "path string, n_records long"))


class Member:
    """A gzip member's content, inflated only as far as it is asked for."""

    def __init__(self, source, ahead: bytes):
        self.source, self.ahead, self.ready = source, ahead, b""
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.ahead or self.source.read(READ_BYTES)
        if not self.inflate.unconsumed_tail:
            self.ahead = b""
        if not data:
            raise ValueError("an archive ends inside a record")
        self.ready += self.inflate.decompress(data, READ_BYTES)
        return True

    def line(self) -> bytes:
        while b"\r\n" not in self.ready:
            if not self._more():
                raise ValueError("a record ends inside its header")
        out, _, self.ready = self.ready.partition(b"\r\n")
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.ready and not self._more():
                raise ValueError("a record is shorter than its Content-Length")
            out, self.ready = self.ready[:n], self.ready[n:]
            n -= len(out)
            yield out

    def end(self) -> bytes:
        """The two line ends of a record must follow; what lies behind the member is returned."""
        while self._more():
            pass
        if self.ready != b"\r\n\r\n":
            raise ValueError("a record doesn't end with two line ends")
        return self.inflate.unused_data + self.ahead


def header(member: Member) -> dict[str, str]:
    out = {}
    while line := member.line():
        key, _, value = line.decode().partition(":")
        out[key.lower()] = value.strip()
    return out


def read_records(source) -> Iterator[dict]:
    """Records of one archive in order; a digest or length that doesn't hold is an error."""
    ahead = source.read(READ_BYTES)
    while ahead:
        member = Member(source, ahead)
        if member.line() not in (b"WARC/1.0", b"WARC/1.1"):
            raise ValueError("not a WARC record")
        head = header(member)
        length, kind = int(head["content-length"]), head["warc-type"]
        block, payload, http, seen, parts = hashlib.sha256(), hashlib.sha256(), b"", False, []
        for piece in member.pieces(length):
            block.update(piece)
            if not seen:
                http += piece
                before, mark, piece = http.partition(b"\r\n\r\n")
                if not mark:
                    continue
                http, seen = before, True
            payload.update(piece)
            parts.append(piece)
        if "warc-block-digest" in head and head["warc-block-digest"] != f"sha256:{block.hexdigest()}":
            raise ValueError("a block digest doesn't hold")
        digest = head["warc-payload-digest"].removeprefix("sha256:")
        if kind == "response" and payload.hexdigest() != digest:
            raise ValueError("a payload digest doesn't hold")
        stated = dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])
        page = lambda uri: int(v) if (v := uri.removeprefix("<urn:page:").removesuffix(">")) else None
        yield {
            "page_id": page(head["warc-record-id"]), "record_type": kind, "payload_digest": digest, "payload_bytes": int(stated[b"Content-Length"]),
            "refers_to": page(head["warc-refers-to"]) if kind == "revisit" else None, "payload": b"".join(parts),
        }
        ahead = member.end() or source.read(READ_BYTES)


FIELDS = "page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Records of all archives in the manifest, read where the tasks run."""
    schema = FIELDS if with_payload else FIELDS.rpartition(",")[0]
    names = [f.split()[0] for f in schema.split(", ")]
    types = dict(zip(FIELDS.replace(",", "").split()[::2], (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary())))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held: list[dict] = []
                size = 0
                with store.open_input_stream(f"{root}/{path}", compression=None) as source:
                    for r in read_records(source):
                        held.append(r)
                        size += len(r["payload"]) if with_payload else 100
                        if size >= 1 << 20:
                            yield flush(held)
                            held, size = [], 0
                if held:
                    yield flush(held)

    def flush(held: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in held], types[n]) for n in names], names=names)

    files = manifest.select("path").repartition(F.col("path"))
    return files.mapInArrow(read, schema)


def archive_folder(spark: SparkSession) -> str:
    root = scratch_folder(spark)
    return f"{root if ':' in root.split('/')[0] else 'file://' + root}/warc-{uuid.uuid4().hex}"


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = archive_folder(spark)
    manifest = write_archives(classified(table(spark, sf_dir, "pages")), folder)
    return read_archives(manifest, folder, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
QUERIES = {"op9_warc": (op9_warc, SQL)}
