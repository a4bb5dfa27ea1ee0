"""WARC archives: one gzip member per record, read back sequentially.

Writing: each task streams its rows into archives of bounded size in a shared folder and returns the
archives' paths. A task that runs again writes new names, and only the names of the attempt that
succeeded are returned, so lost executors leave no half archive in the results.

Reading: one archive per task, in blocks. zlib inflates a member step by step; the record's header
ends at the empty line, its Content-Length frames the block, and the block's SHA-1 is compared with
the stated digest, as is the payload's for responses. A damaged member raises an error.

Rows: null payloads are empty. Of equal payloads of at least `least_bytes` bytes, all rows with the
smallest id are responses and others revisits of it. Null ids are written with no id and are
responses. Extra columns are not carried along. No rows give no archives.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import bounded_batches
from gristmill.session import cut, shared_dir

ARCHIVE_BYTES = 32 << 20
BLOCK = 256 << 10
RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "target string, payload binary, block_ok boolean"
)


def digest(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def member(page_id, target, payload: bytes, refers_to, sha1: str) -> bytes:
    """One record as a gzip member of its own. A revisit names its response and has no payload."""
    revisit = refers_to is not None
    block = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        + f"Content-Length: {len(payload)}\r\n\r\n".encode()
    )
    if not revisit:
        block += payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{target}|{sha1}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {' '.join((target or '').split())}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{sha1}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head.insert(5, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.insert(6, f"X-Refers-To-Page-Id: {refers_to}")
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def _members(stream: BinaryIO) -> Iterator[bytearray]:
    """Each gzip member's content, inflated in steps; the next one begins where it ends."""
    data = b""
    while True:
        data = data or stream.read(BLOCK)
        if not data:
            return
        inflate, raw = zlib.decompressobj(31), bytearray()
        while not inflate.eof:
            data = inflate.unconsumed_tail or data or stream.read(BLOCK)
            if not data:
                raise ValueError("the archive ends within a record")
            raw += inflate.decompress(data, BLOCK)
            data = b""
        data = inflate.unused_data
        yield raw


def records(stream: BinaryIO) -> Iterator[tuple]:
    """Tuples as in RECORD. Bounded by the largest record."""
    for raw in _members(stream):
        end = raw.find(b"\r\n\r\n")
        first, *lines = bytes(raw[:end]).decode("utf-8").split("\r\n")
        if end < 0 or not first.startswith("WARC/"):
            raise ValueError("no record header")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = int(head["content-length"])
        block = bytes(raw[end + 4 : end + 4 + length])
        if len(block) != length or raw[end + 4 + length :] != b"\r\n\r\n":
            raise ValueError("content length and record differ")
        if f"sha1:{digest(block)}" != head["warc-block-digest"]:
            raise ValueError("block digest differs")
        http, _, payload = block.partition(b"\r\n\r\n")
        stated = head["warc-payload-digest"].removeprefix("sha1:")
        if head["warc-type"] == "response" and digest(payload) != stated:
            raise ValueError("payload digest differs")
        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length:"))
        refers = head.get("x-refers-to-page-id")
        yield (
            int(head["x-page-id"]) if head["x-page-id"] else None, size, stated, head["warc-type"],
            int(refers) if refers else None, head["warc-target-uri"],
            payload if head["warc-type"] == "response" else None, True,
        )


def planned(
    pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0
) -> DataFrame:
    """page_id, url, html and refers_to (null for responses). Digests alone are shuffled for the
    choice; copies are pre-aggregated."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    )
    rows = rows.withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    keys = rows.where((F.octet_length("html") >= least_bytes) & F.col("page_id").isNotNull())
    lowest = keys.groupBy("sha1").agg(F.min("page_id").alias("lo"), F.max("page_id").alias("hi"))
    # only payloads that stand on several ids need the join
    lowest = cut(lowest.where(F.col("lo") != F.col("hi")).select("sha1", "lo"), "warc-copies")
    ids = cut(
        keys.select("sha1", "page_id").join(lowest, "sha1").where(F.col("page_id") != F.col("lo"))
        .select("sha1", "page_id", "lo").distinct(),
        "warc-revisits",
    )
    return rows.join(ids, ["sha1", "page_id"], "left").select(
        "page_id", "url", "html", F.col("lo").alias("refers_to")
    )


def write(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of `rows` (page_id, url, html, refers_to) in `folder`: a table of their paths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        fs.create_dir(root, recursive=True)
        stem, out, size, n, done = uuid.uuid4().hex, None, 0, 0, []
        for batch in batches:
            for row in zip(*[batch.column(c) for c in ("page_id", "url", "html", "refers_to")]):
                page_id, url, html, refers = (x.as_py() for x in row)
                payload = html.encode("utf-8")
                if out is None:
                    path = f"{root}/{stem}-{len(done):05d}.warc.gz"
                    out, size, n = fs.open_output_stream(path, compression=None), 0, 0
                raw = member(page_id, url, payload, refers, digest(payload))
                out.write(raw)
                size, n = size + len(raw), n + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((path, n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n, size))
        if done:
            a, b, c = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b, pa.int64()), pa.array(c, pa.int64())], names=["path", "n", "size"]
            )

    bounded_batches(rows.sparkSession)
    return cut(rows.mapInArrow(run, "path string, n long, size long"), "warc-archives")


def read(archives: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives, one archive after another per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = pa.fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        names = [x.split()[0] for x in RECORD.split(", ")]
        for batch in batches:
            for path in batch["path"]:
                held, size = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for record in records(stream):
                        if not with_payload:
                            record = (*record[:6], None, True)
                        held.append(record)
                        size += len(record[6] or b"") + 200
                        if size > 4 << 20:
                            yield frame(held, names)
                            held, size = [], 0
                if held:
                    yield frame(held, names)

    def frame(held, names):
        out = pd.DataFrame(held, columns=names, dtype=object)
        for c in ("page_id", "payload_bytes", "refers_to"):
            out[c] = out[c].astype("Int64")
        return out

    count = max(1, archives.count())
    dealt = archives.select("path").repartitionByRange(count, "path")
    return dealt.mapInPandas(run, RECORD)


def round_trip(pages: DataFrame, with_payload: bool = False, **options) -> DataFrame:
    """Pages written as archives and read back."""
    base = shared_dir(pages.sparkSession).rstrip("/")
    folder = f"{base}/gristmill/warc-{uuid.uuid4().hex}"
    return read(write(planned(pages, **options), folder), folder, with_payload)
