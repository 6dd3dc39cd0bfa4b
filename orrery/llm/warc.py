"""WARC archives and a normaliser for those that are one gzip stream.

Pages are written as WARC/1.1 records, first the way many crawlers leave them: one gzip stream for the
whole file. The normaliser inflates such a stream once, from start to end, writes every record as a
gzip member of its own and a sidecar index (one line a record: offset, length, record id). With the
index a reader opens any record alone.

Records of equal payloads (SHA-1 and length) of at least ``least_bytes`` bytes become one response, that
of the smallest page id, and revisits of it without payload; the digest stays that of the full payload,
whose length is kept in a header of its own.

Defined results: a null html is an empty payload; rows with a null page id are left out; rows that
repeat a page id are all written (an id that is the smallest of its payload is a response each time);
other columns are ignored. A group of equal payloads is found from digests; payloads never meet.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.files import open_store, put
from orrery.llm.shared import Workspace

#: Compressed bytes that are inflated at a time.
BLOCK = 1 << 16
LEVEL = 4


def record(page_id: int, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    body = b"" if refers_to is not None else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Target-URI: {(url or '').translate({10: '%0A', 13: '%0D'})}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        *([] if refers_to is None else ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]),
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers in lower case, body) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


def inflated(stream):
    """The bytes of a gzip file, block by block, whatever members it has."""
    z = zlib.decompressobj(31)
    while block := stream.read(BLOCK):
        while block:
            yield z.decompress(block)
            block = z.unused_data if z.eof else b""
            if z.eof:
                z = zlib.decompressobj(31)


def records(blocks):
    """Whole records from inflated blocks; holds one record and a block at most."""
    held, need = bytearray(), -1
    for block in blocks:
        held += block
        while True:
            if need < 0:
                at = held.find(b"\r\n\r\n")
                if at < 0:
                    break
                length = next(int(x[16:]) for x in bytes(held[:at]).split(b"\r\n") if x[:16].lower() == b"content-length: ")
                need = at + 4 + length + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = -1
    if held:
        raise ValueError(f"{len(held)} bytes after the last whole record")


def normalise(root: str, name: str) -> tuple[str, str, int]:
    """Rewrites archive ``name`` of one stream; (archive, index, records). The old archive is left to the caller."""
    store, path = open_store(root)
    stem = name.removesuffix(".mono.warc.gz")
    lines: list[str] = []

    def members(out):
        at = 0
        with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
            for raw in records(inflated(stream)):
                z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = z.compress(raw) + z.flush()
                out.write(member)
                lines.append(f"{at}\t{len(member)}\t{parse(raw)[0]['warc-record-id']}\n")
                at += len(member)

    put(root, f"{stem}.warc.gz", members)
    put(root, f"{stem}.idx", lambda out: out.write("".join(lines).encode()))
    return f"{stem}.warc.gz", f"{stem}.idx", len(lines)


def _archive(root: str):
    def run(batches):
        name = f"part-{TaskContext.get().partitionId():06d}.mono.warc.gz"
        written = [0]

        def stream(out):
            z = zlib.compressobj(1, zlib.DEFLATED, 31)
            for batch in batches:
                for k in range(batch.num_rows):
                    page, url, html, refers = (batch.column(c)[k].as_py() for c in range(4))
                    out.write(z.compress(record(page, url, (html or "").encode(), refers)))
                    written[0] += 1
            out.write(z.flush())

        put(root, name, stream)
        archive, index, n = normalise(root, name)
        store, path = open_store(root)
        store.delete_file(f"{path}/{name}")
        if n != written[0]:
            raise ValueError(f"{name}: {written[0]} records written, {n} read")
        yield pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([index]), pa.array([n])], names=["archive", "index", "n_records"])

    return run


def write_archives(pages: DataFrame, least_bytes: int = 0) -> tuple[str, DataFrame]:
    """(folder, rows (archive, index, n_records)) of the pages' normalised archives."""
    ws = Workspace(pages.sparkSession, "warc")
    root = ws.path("archives")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).where("page_id is not null")
    pages = pages.withColumn("digest", F.concat_ws(":", F.sha1("html"), F.octet_length("html").cast("string")))
    known = pages.where(F.octet_length("html") >= least_bytes).select("page_id", "digest")
    shared = known.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    revisits = ws.save(known.join(shared, "digest").where("page_id > first").select("page_id", "digest", "first").distinct(), "revisits")
    marked = pages.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "html", F.col("first").alias("refers_to"))
    files = marked.mapInArrow(_archive(root), "archive string, index string, n_records long")
    return root, ws.save(files, "files")


def _read(root: str):
    def run(batches):
        store, path = open_store(root)
        for batch in batches:
            for archive, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                with store.open_input_file(f"{path}/{index}") as f:
                    entries = [line.split("\t") for line in f.read().decode().splitlines()]
                with store.open_input_file(f"{path}/{archive}") as f:
                    for at, size, name in entries:
                        f.seek(int(at))
                        fields, body = parse(zlib.decompress(f.read(int(size)), 31))
                        if fields["warc-record-id"] != name:
                            raise ValueError(f"{archive} has another record at {at} than {name}")
                        digest, length = fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["x-payload-length"])
                        if fields["warc-type"] == "response" and (len(body) != length or base64.b32encode(hashlib.sha1(body).digest()).decode() != digest):
                            raise ValueError(f"{archive}: {name} has another payload than its digest says")
                        refers = fields.get("warc-refers-to")
                        rows.append((int(name[10:-1]), length, digest, fields["warc-type"], int(refers[10:-1]) if refers else None))
                cols = list(zip(*rows)) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return run


def read_archives(root: str, files: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record, read by the index."""
    files = files.where("n_records > 0")
    n = max(1, files.count())
    return files.repartition(n).mapInArrow(_read(root), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
