"""WARC archives of pages: written with an index, read back by coalesced byte ranges.

Each task writes one archive of gzip members, one per record, to the shared folder through
pyarrow's file systems, and yields an index row per record: file, offset, length, URL and
digest. An archive's name holds the attempt's number, so a task that is run again writes
another file and the index names the one that was finished. A reader sorts the index rows
that it wants by file and offset and reads neighbours in one go; its tasks get blocks of
archives, so they grow in number with the bytes.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterbill.llm.common import new_folder, stage

LEAST_SHARED = 100  # bytes from which equal payloads are stored once
GAP = 64 << 10  # bytes that are read over rather than asked for anew
MOST_RANGE = 8 << 20  # bytes of one read, unless a single record is longer; a task's share of an archive comes in such blocks
TASK_BYTES = 32 << 20  # bytes of archives for each reading task
#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"  # the pages have no time of capture
INDEX = "page_id long, url string, payload_digest string, record_type string, file string, offset long, length long"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _record_id(page_id: int | None, url: str | None, digest: str) -> str:
    return _id(f"page:{page_id}:{url}:{digest}")


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20%\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(
    page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int, refers_to: int | None, first_url: str | None
) -> bytes:
    """One record. A revisit (no payload) names the record, URL and page that it refers to, and the full size."""
    fields = [
        ("WARC-Type", "response" if payload is not None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, url, digest)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(size)),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if url is not None:
        fields.append(("WARC-Target-URI", _uri(url)))
    if payload is None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, first_url, digest))]
        if first_url is not None:
            fields += [("WARC-Refers-To-Target-URI", _uri(first_url)), ("WARC-Refers-To-Date", DATE)]
        fields.append(("X-Refers-To-Page", str(refers_to)))
        block = HTTP % size
    else:
        block = HTTP % size + payload
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + head + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields and payload of one record; a malformed one raises ValueError."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(VERSION):
        raise ValueError("no WARC record here")
    fields = dict(line.split(": ", 1) for line in head[len(VERSION) :].decode().split("\r\n"))
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    if not http.startswith(b"HTTP/"):
        raise ValueError("a record holds no response")
    number = lambda k: int(fields[k]) if k in fields else None
    url = fields.get("WARC-Target-URI")
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(fields["X-Payload-Length"])
    if kind == "response":
        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError("a payload is not what its digest says")
    return {
        "page_id": number("X-Page-ID"),
        "url": None if url is None else re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url),
        "record_type": kind,
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": number("X-Refers-To-Page"),
        "payload": payload if kind == "response" else None,
    }


def _store(uri: str) -> tuple:
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def with_roles(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """page_id, url, html (null for a revisit), digest, size, refers_to and first_url of each page.

    Of equal payloads of at least `least` bytes the smallest page_id is the response. Rows
    that share that id are all responses, and revisits name the one of the smallest URL; a
    null id is a revisit unless all ids are null.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    hashed = pages.select(
        "page_id", "url", F.col("html"), F.sha2(body, 256).alias("digest"), F.octet_length(body).cast("long").alias("size")
    )
    firsts = (
        hashed.where(F.col("size") >= least)
        .groupBy("digest")
        .agg(
            F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("of"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("n > 1 AND of IS NOT NULL")
        .select("digest", F.col("of.page_id").alias("first"), F.col("of.url").alias("first_url"))
    )
    joined = hashed.join(firsts, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "url", "digest", "size",
        F.when(again, F.col("first")).alias("refers_to"),
        F.when(again, F.col("first_url")).alias("first_url"),
        F.when(~again, F.coalesce(F.col("html"), F.lit(""))).alias("html"),
    )


def write(pages: DataFrame, folder: str, least: int = LEAST_SHARED) -> DataFrame:
    """Write pages as archives in `folder` (a URI that all executors reach); the index, staged."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"pages-{context.partitionId():05d}-{context.taskAttemptId()}.warc.gz"
        file, at = None, 0
        for batch in batches:
            rows = []
            for page_id, url, digest, size, refers_to, first_url, html in zip(*(c.to_pylist() for c in batch.columns)):
                if file is None:
                    store, path = _store(folder)
                    store.create_dir(path, recursive=True)
                    file = store.open_output_stream(f"{path}/{name}", compression=None)
                payload = None if html is None else html.encode()
                member = gzip.compress(record(page_id, url, payload, digest, size, refers_to, first_url), 6, mtime=0)
                file.write(member)
                kind = "response" if refers_to is None else "revisit"
                rows.append((page_id, url, digest, kind, name, at, len(member)))
                at += len(member)
            schema = pa.schema([(c.split()[0], pa.int64() if "long" in c else pa.string()) for c in INDEX.split(", ")])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema
            )
        if file is not None:
            file.close()

    rows = with_roles(pages, least).select("page_id", "url", "digest", "size", "refers_to", "first_url", "html")
    return stage(rows.mapInArrow(work, INDEX), "warc-index")


def ranges(rows: Iterator[tuple], gap: int = GAP, most: int = MOST_RANGE) -> Iterator[tuple]:
    """Coalesce sorted (file, offset, length) to (file, start, end, [(offset, length)])."""
    now: list | None = None
    for file, offset, length in rows:
        if now and now[0] == file and offset - now[2] <= gap and max(now[2], offset + length) - now[1] <= most:
            now[2] = max(now[2], offset + length)
            now[3].append((offset, length))
        else:
            if now:
                yield tuple(now)
            now = [file, offset, offset + length, [(offset, length)]]
    if now:
        yield tuple(now)


def read(index: DataFrame, folder: str, where: Column | None = None) -> DataFrame:
    """The records of the index rows that meet `where`, all by default, by byte-range reads.

    The work is spread by bytes: blocks of the archives go to as many tasks as the wanted
    records' bytes ask for, and to no fewer than run at once.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        schema = pa.schema(
            [(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in RECORD.split(", "))]
        )
        wanted = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        name, file = None, None
        for at, start, end, members in ranges(wanted):
            if at != name:
                name, file = at, store.open_input_file(f"{path}/{at}")
            data = file.read_at(end - start, start)
            some = []
            for offset, length in members:
                got = zlib.decompress(data[offset - start : offset - start + length], wbits=31)
                some.append(parse(got))
            yield pa.RecordBatch.from_pylist(some, schema=schema)

    wanted = index if where is None else index.where(where)
    size = wanted.agg(F.sum("length")).first()[0] or 0
    tasks = max(-(-size // TASK_BYTES), index.sparkSession.sparkContext.defaultParallelism)
    return (
        wanted.select("file", "offset", "length")
        .repartition(tasks, "file", F.floor(F.col("offset") / MOST_RANGE))
        .sortWithinPartitions("file", "offset")
        .mapInArrow(work, RECORD)
    )


def round_trip(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """Write all pages, read all archives back: one row per page, from its record.

    A null html is an empty payload. Rows with equal ids are records of their own. A null
    url is no URI. Other columns are ignored; an empty table gives an empty one.
    """
    folder = new_folder(pages.sparkSession, "warc")
    index = write(pages, folder, least)
    return read(index, folder).drop("payload")
