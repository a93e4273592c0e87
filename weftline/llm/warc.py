"""Deterministic sharded WARC archives.

Records are range-sorted by page id and written by one task for each range.
A task rolls to its next file once the compressed size passes a limit. Each
record is a gzip member of its own; headers and digests are generated anew from
the payload. A file is written under a temporary name and renamed when it is
complete; a manifest beside the files, in the archive's folder, names those
that count with their records, bytes and SHA-256, and reading holds each file
against it. Names and bytes depend on the records and the ranges only, so an
attempt after a lost executor writes the same.

Which record is a revisit is decided on digests and ids alone, a minimum by
digest. The decisions travel to the writer in the same range shuffle as the
pages, sorted just before the page they concern, so payloads are shuffled once.

Defined cases: a null payload is an empty one; a null url is written as
``urn:page:ID``; null page ids sort last; of rows that repeat id and payload
the first is the response and the others revisit it; a payload of any length
is written whole, in one task's memory; an empty table gives no files and an
empty manifest; only the three columns named are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.files import Committed, at
from weftline.scratch import fresh_path, materialize

#: Compressed bytes after which a task starts its next file.
ROLL_BYTES = 128 << 20
#: Payloads below this size are always written in full.
MIN_REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
LEVEL = 5
_SPACE = uuid.UUID("6ba7b812-9dad-11d1-80b4-00c04fd430c8")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, first_page long, last_page long, n_records long, n_bytes long, sha256 string"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"WARC-Block-Digest: sha1:{base32_sha1(block)}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _clean(url: str | None, page: int | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url) if url else f"urn:page:{page}"


def _id(page: int | None, digest: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page}|{digest}|{nth}')}>"


def page_record(page: int | None, url: str | None, payload: bytes, refers: tuple[int | None] | None, nth: int) -> bytes:
    """A response record, or a revisit record where refers holds the original's page id."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", _id(page, digest, nth)), ("WARC-Target-URI", _clean(url, page)), ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response"), ("WARC-Page", str(page)),
    ]
    if refers is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _id(refers[0], digest, 0)), ("WARC-Refers-To-Page", str(refers[0]))]
    return _record(headers, http + (payload if refers is None else b""))


def decisions(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, sha1, refers) for each page whose payload others have too; refers is the smallest such page id."""
    narrow = pages.where(F.octet_length("payload") >= min_bytes).select("page_id", F.sha1("payload").alias("sha1"))
    shared = narrow.groupBy("sha1").agg(F.min("page_id").alias("refers"), F.count("*").alias("n")).where("n > 1").select("sha1", "refers")
    return narrow.join(shared, "sha1").select("page_id", "sha1", "refers").distinct()


def write(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write pages (page_id, url, html) to a new folder; returns the manifest, a row for each file, which lies there too."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    known = materialize(decisions(pages, min_bytes), "warc-decisions")
    rows = pages.select("page_id", F.sha1("payload").alias("sha1"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("refers"), "url", "payload").unionByName(
        known.select("page_id", "sha1", F.lit(0).alias("kind"), "refers", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload")),
    )
    order = F.col("page_id").asc_nulls_last()
    ranged = rows.repartitionByRange(order, "sha1").sortWithinPartitions(order, "sha1", "kind", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        out, summed, seq, pages_in, done = None, None, 0, [], []
        previous, nth, refers = None, 0, None

        def put(record: bytes) -> None:
            data = _member(record)
            out.write(data)
            summed.update(data)

        def close() -> None:
            out.commit()
            ids = [p for p in pages_in if p is not None]
            done.append((out.final.rsplit("/", 1)[1], min(ids, default=None), max(ids, default=None), len(pages_in), out.size, summed.hexdigest()))

        for batch in batches:
            for page, sha, kind, ref, url, body in zip(*(batch.column(c) for c in ("page_id", "sha1", "kind", "refers", "url", "payload"))):
                page, key = page.as_py(), (page.as_py(), sha.as_py())
                if key != previous:
                    previous, nth, refers = key, 0, None
                if not kind.as_py():
                    refers = (ref.as_py(),)
                    continue
                original = refers is None or (nth == 0 and refers[0] == page)
                if out is None:
                    out, summed, pages_in = Committed(folder, f"part-{part:06d}-{seq:04d}.warc.gz"), hashlib.sha256(), []
                    put(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _id(None, "info", part << 16 | seq)), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                put(page_record(page, url.as_py(), body.as_py(), None if original else refers, nth))
                pages_in.append(page)
                nth += 1
                if out.size >= roll_bytes:
                    close()
                    out, seq = None, seq + 1
        if out is not None:
            close()
        schema = pa.schema([("file", pa.string()), *((c, pa.int64()) for c in ("first_page", "last_page", "n_records", "n_bytes")), ("sha256", pa.string())])
        yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*done) if done else ([],) * 6)), schema=schema)

    ranged.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest_of(pages.sparkSession, folder)


def manifest_of(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of an archive written before."""
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


class _Counted:
    """A stream that counts and hashes the bytes read from it."""

    def __init__(self, stream) -> None:
        self.stream, self.size, self.sha = stream, 0, hashlib.sha256()

    def read(self, n: int) -> bytes:
        data = self.stream.read(n)
        self.size += len(data)
        self.sha.update(data)
        return data


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, each unpacked, one at a time."""
    z, parts, rest = zlib.decompressobj(31), [], b""
    while data := rest or stream.read(1 << 20):
        parts.append(z.decompress(data))
        rest = b""
        if z.eof:
            yield b"".join(parts)
            z, parts, rest = zlib.decompressobj(31), [], z.unused_data


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]


def read(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """A row for each page record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, and the payload if asked for.

    Size and digest of a response are taken from the payload read; those of a revisit from its headers. A file
    whose records, bytes or SHA-256 are not those of the manifest is an error: a truncated one is not fewer rows.
    """

    def number(x: str | None) -> int | None:
        return None if x in (None, "None") else int(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["payload"] if with_payload else [])]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(len(names))], names=names)

        for batch in batches:
            for file, *noted in zip(*(batch.column(c).to_pylist() for c in ("file", "n_records", "n_bytes", "sha256"))):
                filesystem, path = at(folder)
                rows, held, n = [], 0, 0
                with filesystem.open_input_stream(f"{path}/{file}", compression=None) as opened:
                    stream = _Counted(opened)
                    for member in _members(stream):
                        headers, block = parse(member)
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(http.decode().rsplit("Content-Length: ", 1)[1].split("\r\n")[0])
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        revisit = headers["WARC-Type"] == "revisit"
                        if not revisit:
                            size, digest = len(payload), base32_sha1(payload)
                        rows.append((number(headers["WARC-Page"]), headers["WARC-Target-URI"], size, digest, headers["WARC-Type"], number(headers.get("WARC-Refers-To-Page")), None if revisit else payload))
                        n += 1
                        held += len(payload) if with_payload else 200
                        if held > 16 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if noted != [n, stream.size, stream.sha.hexdigest()]:
                    raise ValueError(f"{file} holds {n} records in {stream.size} bytes, not those of the manifest: {noted[0]} in {noted[1]}")
                yield batch_of(rows)

    spread = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", payload binary" if with_payload else "")
    return manifest.select("file", "n_records", "n_bytes", "sha256").repartition(spread).mapInArrow(run, schema)


def folder_for(pages: DataFrame) -> str:
    return fresh_path(pages.sparkSession, "warc")
