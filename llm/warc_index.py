"""WARC archives with an index of byte ranges, read back by coalesced ranges."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import pick, shared_folder, staged, width

LEAST = 1000  # bytes of a payload that is worth a revisit record
DATE = "2024-01-01T00:00:00Z"
GAP = 64 << 10  # bytes between two records that one read may pass over
READ = 8 << 20  # bytes of a coalesced read
ARCHIVE = 1 << 30  # bytes of an archive before the next begins
SHARE = 64 << 20  # bytes of archives that one task reads back, about
PRINTABLE = "".join(map(chr, range(0x21, 0x7F)))

INDEX = "page_id long, url string, digest string, archive string, offset long, length long"
READ_BACK = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string,"
    " refers_to long, payload binary"
)


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a folder, and the path in it."""
    scheme, found, rest = folder.partition(":")
    if not found:
        return fs.LocalFileSystem(), folder
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(("s3" if scheme in ("s3a", "s3n") else scheme) + ":" + rest)


def record(page, url, payload: bytes, digest: str, refers_to=None) -> bytes:
    """A WARC record: a whole response, or a revisit with the response's HTTP header only."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{'' if page is None else page}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else quote(url, safe=PRINTABLE),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if refers_to is not None:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
    lines = [f"{name}: {value}" for name, value in head.items() if value is not None]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n"


class Parsed(NamedTuple):
    page: int | None
    kind: str
    size: int
    digest: str
    refers_to: int | None
    payload: bytes


def fields(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(": ") for line in lines.decode().split("\r\n")[1:])
    return {name.lower(): value for name, _, value in pairs}


def parsed(data: bytes) -> Parsed:
    """A record; a payload that does not have the digest of its header is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = fields(head)
    http, _, payload = rest[: int(warc["content-length"])].partition(b"\r\n\r\n")
    number = lambda name: int(x) if (x := warc[name][len("<urn:page:") : -1]) else None
    kind, digest = warc["warc-type"], warc["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"the payload of record {warc['warc-record-id']} is damaged")
    size = len(payload) if kind == "response" else int(fields(http)["content-length"])
    refers_to = number("warc-refers-to") if kind == "revisit" else None
    return Parsed(number("warc-record-id"), kind, size, digest, refers_to, payload)


def with_roles(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``; the last is null for responses.

    Payloads are equal if their SHA-256 is. Groups are reduced by partial sums; the few
    rows of groups with several pages are joined back, and Spark splits hot ones.
    """
    rows = pick(pages, page_id="page_id", url="url", html="html").select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"),
    )
    key = F.when(F.octet_length("payload") >= least, F.sha2("payload", 256))
    keyed = rows.withColumn("_key", key)
    groups = (
        keyed.filter(F.col("_key").isNotNull())
        .groupBy(F.col("_key").alias("_group"))
        .agg(F.max("page_id").alias("_kept"), F.count(F.lit(1)).alias("_n"))
        .filter((F.col("_n") > 1) & F.col("_kept").isNotNull())
    )
    groups = staged(groups, "payload-groups")
    revisit = F.col("_kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_kept"))
    return keyed.join(groups, F.col("_key") == F.col("_group"), "left").select(
        "page_id",
        "url",
        "payload",
        F.sha1("payload").alias("digest"),
        F.when(revisit, F.col("_kept")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """The index ``page_id, url, digest, archive, offset, length`` of written archives.

    Every task writes archives of its own, a gzip member a record, under a name of the
    attempt; only the index rows of the attempt that Spark commits name them, so repeated
    and lost tasks do no harm. A folder in a store that Arrow's file systems reach.
    """
    folder = folder or f"{shared_folder(pages.sparkSession)}/warc-{uuid4().hex}"
    store, path = opened(folder)
    store.create_dir(path, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = opened(folder)
        task, out, at, number = TaskContext.get(), None, 0, 0
        attempt = f"part-{task.partitionId():05d}-{uuid4().hex}"
        try:
            for batch in batches:
                rows = []
                columns = ("page_id", "url", "payload", "digest", "refers_to")
                for page, url, payload, digest, to in zip(*(batch[c].to_pylist() for c in columns)):
                    if out is None or at >= ARCHIVE:
                        if out is not None:
                            out.close()
                        name, at, number = f"{attempt}-{number}.warc.gz", 0, number + 1
                        out = store.open_output_stream(f"{path}/{name}", compression=None)
                    squeeze = zlib.compressobj(4, zlib.DEFLATED, 31)
                    data = squeeze.compress(record(page, url, payload, digest, to)) + squeeze.flush()
                    out.write(data)
                    rows.append((page, url, digest, name, at, len(data)))
                    at += len(data)
                if rows:
                    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
                    names = ["page_id", "url", "digest", "archive", "offset", "length"]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names
                    )
        finally:
            if out is not None:
                out.close()

    written = with_roles(pages).mapInArrow(write, INDEX)
    return staged(written, "warc-index").withColumn(
        "archive", F.concat(F.lit(folder + "/"), F.col("archive"))
    )


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that ``index`` (all or selected rows of it) names, read and checked.

    ``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload``. The
    byte ranges are dealt to tasks by the sum of their lengths, which reads the index once more,
    range-partitioned and sorted by archive and offset; neighbours less
    than ``GAP`` apart are one read of up to about ``READ`` bytes. A revisit has the size
    and digest of the full payload, and no payload. ``payloads=False`` leaves them out.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores: dict[str, tuple] = {}

        def fetched(run: list[dict]) -> pa.RecordBatch:
            folder, _, name = run[0]["archive"].rpartition("/")
            store, path = stores.setdefault(folder, opened(folder))
            start = run[0]["offset"]
            end = max(r["offset"] + r["length"] for r in run)
            with store.open_input_file(f"{path}/{name}") as file:
                data = file.read_at(end - start, start)
            rows = []
            for r in run:
                at = r["offset"] - start
                x = parsed(zlib.decompress(data[at : at + r["length"]], 31))
                rows.append((x.page, r["url"], x.size, x.digest, x.kind, x.refers_to, x.payload if payloads else None))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        run: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if run:
                    last = run[-1]
                    end = last["offset"] + last["length"]
                    near = row["archive"] == last["archive"] and row["offset"] - end <= GAP
                    if not near or end - run[0]["offset"] >= READ:
                        yield fetched(run)
                        run = []
                run.append(row)
        if run:
            yield fetched(run)

    wanted = index.select("url", "archive", "offset", "length")
    # By the bytes of the archives: those of the index, which Spark sees, say little of the work.
    total = wanted.agg(F.sum("length")).first()[0] or 0
    tasks = max(width(index.sparkSession), -(-total // SHARE))
    ranges = wanted.repartitionByRange(tasks, "archive", "offset")
    return ranges.sortWithinPartitions("archive", "offset").mapInArrow(read, READ_BACK)


def op9_warc_index(spark, sf_dir: str) -> DataFrame:
    """Every page written and read back. Null html is an empty payload, a null url is left
    out, pages that repeat the largest id of their group are all responses, a null id is
    smaller than any other, and an empty table gives no rows."""
    index = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read_records(index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE = """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
         q AS (SELECT *, max(page_id) OVER (PARTITION BY b) AS kept FROM p),
         r AS (SELECT *, octet_length(b) >= 1000 AND page_id <> kept AS again FROM q)
    SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest,
           CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN again THEN kept END AS refers_to
    FROM r
"""
