"""WARC archives: a writer that stores equal payloads once, and a splittable reader.

Each record is a gzip member of its own. The writer makes one file in each
task, below the given folder, and returns a manifest; only files of a written
manifest are ever read, so what a lost task left behind does no harm. The
reader cuts files into byte ranges. A task looks for the gzip magic in its
range, decodes each place far enough to see a WARC header, and takes the whole
record if it starts inside the range, reading past the end of the range where
it must. No index and no order of files is needed.

Of records with one payload of `LEAST` bytes or more, the one with the largest
page_id is a response and the others are revisits of it. The choice is made by
aggregation of digests, for payloads that occur more than once. If these are
few the pages are not shuffled at all; else they meet in a join, where a
payload that a third of all pages share is split like any other rows.

Defined cases: a null html is an empty payload; null page_ids are lowest in
order; of rows alike in id, url and payload one is the response and the rest
revisit it; a null url is left out of its record; an empty table gives
archives without records and an empty result; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_path, arrow_tasks, written

LEAST = 1000
SPLIT = 4 << 20
READ = 1 << 18
#: So many chosen responses, of about 100 bytes, go to every task; more meet the pages in a join.
BROADCAST_ROWS = 100_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MAGIC = b"\x1f\x8b\x08"
_ID = re.compile(r"<urn:x-page:(-?\d*):([0-9a-f]{40})>")


def _open(uri: str):
    """File system and path of a place in the shared folder."""
    return pa.fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pa.fs.LocalFileSystem(), uri)


# ---------------------------------------------------------------- one record

def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int,
           refers_to: tuple[int | None] | None) -> bytes:
    """A gzip member with one WARC record; ``refers_to``: the response's page_id in a tuple, for revisits."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    fields = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", record_id(page_id, digest)),
              ("WARC-Date", DATE),
              ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    if refers_to:
        fields += [("WARC-Refers-To", record_id(refers_to[0], digest)), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(head.encode() + block + b"\r\n\r\n") + pack.flush()


def headers(data: bytes) -> tuple[dict[str, str], int] | None:
    """Fields, by lower-case name, and the length of a header block with its blank line."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    lines = data[:end].decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}, end + 4


def parse(data: bytes) -> dict | None:
    """A record as a row: page_id, url, payload (None for revisits), bytes, digest, type, refers_to."""
    head = headers(data) if data.startswith(b"WARC/1.") else None
    if head is None or not head[0].get("content-length", "").isdigit():
        return None
    fields, at = head
    block = data[at: at + int(fields["content-length"])]
    if len(block) < int(fields["content-length"]) or fields.get("warc-type") not in ("response", "revisit"):
        return None
    http = headers(block)
    me, to = _ID.search(fields.get("warc-record-id", "")), _ID.search(fields.get("warc-refers-to", ""))
    if http is None or me is None:
        return None
    number = lambda m: int(m[1]) if m and m[1] else None
    revisit = fields["warc-type"] == "revisit"
    payload = None if revisit else block[http[1]:]
    stated = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
    return {"page_id": number(me), "url": fields.get("warc-target-uri"), "payload": payload,
            "payload_bytes": int(http[0]["content-length"]) if revisit else len(payload),
            "payload_digest": stated if revisit else hashlib.sha1(payload).hexdigest(),
            "record_type": fields["warc-type"], "refers_to": number(to)}


# ---------------------------------------------------------------- byte ranges

def member(data: bytes) -> tuple[bytes, int] | None:
    """The content of the gzip member at the start of ``data`` and its compressed length; None if it is not whole."""
    unpack = zlib.decompressobj(31)
    try:
        out = unpack.decompress(data)
    except zlib.error:
        return None
    return (out, len(data) - len(unpack.unused_data)) if unpack.eof else None


def begins_record(data: bytes) -> bool:
    """Whether a gzip member whose content begins like a WARC record starts here."""
    try:
        return zlib.decompressobj(31).decompress(data[:512], 64).startswith(b"WARC/1.")
    except zlib.error:
        return False


def records_in(file, start: int, end: int) -> Iterator[dict]:
    """Rows of the records that start in [start, end) of an open file of gzip members."""
    size = file.size()
    at, buffer, base = start, b"", start  # buffer holds the bytes from base on

    def fill(upto: int) -> None:
        """Have the buffer reach at least ``upto``, or the end of the file."""
        nonlocal buffer, base
        if at > base:
            buffer, base = buffer[at - base:], at
        have = base + len(buffer)
        if have < min(upto, size):
            file.seek(have)
            buffer += file.read(max(READ, min(upto, size) - have))

    while at < min(end, size):
        fill(at + 1024)
        found = buffer.find(_MAGIC, at - base)
        if found < 0 or base + found >= end:
            at = max(at + 1, base + len(buffer) - len(_MAGIC) + 1)
            continue
        at = base + found
        fill(at + 1024)
        if not begins_record(buffer[at - base: at - base + 512]):
            at += 1
            continue
        reach = READ
        while (whole := member(buffer[at - base:])) is None and base + len(buffer) < size:
            fill(at + reach)
            reach *= 2
        row = parse(whole[0]) if whole else None
        if row is None:
            at += 1
            continue
        yield row
        at += whole[1]


# ---------------------------------------------------------------- Spark

def planned(pages: DataFrame, least: int = LEAST, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """page_id, url, payload, digest, size and, for revisits, the response's id in ``keeper``."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = (pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"))
            .select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size")))
    alike = (rows.where(F.col("size") >= least).groupBy("digest", "page_id", "url")
             .agg(F.count(F.lit(1)).alias("n")))
    chosen = written(alike.groupBy("digest")
                     .agg(F.max(F.struct("page_id", "url", "n")).alias("best"), F.sum("n").alias("all"))
                     .where("all > 1").select("digest", "best"), "responses")
    known = F.broadcast(chosen) if chosen.count() <= broadcast_rows else chosen
    joined = rows.join(known, "digest", "left")
    best = (F.col("best").isNotNull() & F.col("page_id").eqNullSafe(F.col("best.page_id"))
            & F.col("url").eqNullSafe(F.col("best.url")))
    keeper = F.when(F.col("best").isNotNull(), F.struct(F.col("best.page_id").alias("page_id")))
    cols = ["page_id", "url", "payload", "digest", "size"]
    if chosen.where("best.n > 1").limit(1).count() == 0:
        return joined.select(*cols, F.when(~best, keeper).alias("keeper"))
    # Rows alike in id, url and payload: one response, the others revisits of it.
    single = joined.where(~best | (F.col("best.n") == 1)).select(*cols, F.when(~best, keeper).alias("keeper"))
    copies = (joined.where(best & (F.col("best.n") > 1)).groupBy("page_id", "url", "digest", "size")
              .agg(F.min("payload").alias("payload"), F.count(F.lit(1)).alias("n"))
              .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))))
    return single.unionByName(copies.select(*cols, F.when(
        F.col("nth") > 1, F.struct(F.col("page_id").alias("page_id"))).alias("keeper")))


def write(pages: DataFrame, folder: str, least: int = LEAST) -> DataFrame:
    """Write the archives below ``folder``; the written manifest (path, size, records)."""
    spark = pages.sparkSession
    arrow_tasks(spark)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.warc.gz"
        out, size, n = None, 0, 0
        for b in batches:
            for r in b.to_pylist():
                if out is None:
                    fs, path = _open(name)
                    out = fs.open_output_stream(path, compression=None)
                keeper = (r["keeper"]["page_id"],) if r["keeper"] else None
                data = record(r["page_id"], r["url"], r["payload"], r["digest"], r["size"], keeper)
                out.write(data)
                size, n = size + len(data), n + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "size": [size], "records": [n]})

    return written(planned(pages, least).mapInArrow(run, "path string, size long, records long"), "manifest")


def read(spark: SparkSession, manifest: DataFrame, split: int = SPLIT, payloads: bool = True) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to of every record.

    ``manifest``: (path, size) of the files. ``payloads`` False leaves the payload null.
    """
    ranges = (manifest.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1,
                                                                    F.lit(split).cast("long"))).alias("start")))
    n = ranges.count()
    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] if payloads or k != "payload" else None for r in rows], t)
                 for k, t in zip(names, types)], names)

        for b in batches:
            for r in b.to_pylist():
                fs, path = _open(r["path"])
                with fs.open_input_file(path) as f:
                    rows: list[dict] = []
                    for row in records_in(f, r["start"], min(r["start"] + split, r["size"])):
                        rows.append(row)
                        if len(rows) == 500:
                            yield out(rows)
                            rows = []
                    if rows:
                        yield out(rows)

    dealt = ranges.repartition(max(1, min(n, 10_000)), "path", "start")
    return dealt.mapInArrow(run, "page_id long, url string, payload binary, payload_bytes long, "
                                 "payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read the records back, without payloads."""
    spark = pages.sparkSession
    manifest = write(pages, shared_path(spark, "warc"))
    return read(spark, manifest, payloads=False).drop("payload", "url")
