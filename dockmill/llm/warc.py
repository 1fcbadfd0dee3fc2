"""WARC archives: index first, then coalesced byte-range reads.

Writing gives an index before anything is read: file, offset, length, URL and
payload digest of every record, as a table.  Each record is a gzip member of
its own, so a byte range is readable alone.  Of records with equal payloads one
is a response and the others are revisits that refer to it.  Reading starts from
any selection of index rows: their ranges are sorted, neighbours closer than
``max_gap`` become one read, and blocks of ``block_bytes`` are dealt over tasks.

A task writes files under names of its own; the index is committed by Spark and
names the files of the attempts that counted, so a task that runs again or an
executor that is lost leaves stray files at most.  Archives go to the shared
folder through Arrow's file systems.

Defined results: a null payload is an empty one; a null id is kept and sorts
before no other (a response if all ids of its payload are null, else a revisit);
rows repeated in full are all written, those with the response's id as
responses; a null URL leaves out the target header; an empty table gives an
empty index.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmill.plans.shared import materialize, new_path

FILE_BYTES = 256 << 20
BLOCK_BYTES = 4 << 20
MAX_GAP = 64 << 10
INDEX = "id string, url string, payload_digest string, record_type string, file string, offset long, length long"
RECORD = "id string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def record(id_: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, is_revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if is_revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-record:{_out(id_)}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URL)}")
    if is_revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:x-record:{_out(refers_to)}>")
    press = zlib.compressobj(1, zlib.DEFLATED, 31)
    return press.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + press.flush()


_URL = "".join(map(chr, range(33, 127))).replace("%", "")


def _out(id_: str | None) -> str:
    return "" if id_ is None else "=" + quote(id_, safe="")


def _in(uri: str) -> str | None:
    from urllib.parse import unquote

    name = uri.removeprefix("<urn:x-record:").removesuffix(">")
    return unquote(name[1:]) if name else None


def parse_record(data: bytes) -> dict:
    """Fields of one gzip member; raises if a response's payload does not have the digest it states."""
    from urllib.parse import unquote

    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(line for line in http.split(b"\r\n") if line.startswith(b"Content-Length: "))[16:])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    url = fields.get("WARC-Target-URI")
    return {
        "id": _in(fields["WARC-Record-ID"]),
        "url": None if url is None else unquote(url),
        "record_type": kind,
        "refers_to": _in(fields["WARC-Refers-To"]) if kind == "revisit" else None,
        "payload_digest": digest,
        "payload_bytes": size,
        "payload": payload if kind == "response" else None,
    }


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_archives(df: DataFrame, id_: str, url: str, payload: str, *, least_revisit: int = 0, file_bytes: int = FILE_BYTES, date: str = "2026-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row; returns the index, a table in the shared folder.

    Payloads of at least ``least_revisit`` bytes are written once: by the row
    with the smallest id.  Only digests and ids are grouped; the one shuffle of
    payloads is the join that tells each row its response, and a payload that
    many rows share is split there as a skewed key.
    """
    spark = df.sparkSession
    folder = new_path(spark, "warc")
    rows = df.select(F.col(id_).alias("id"), F.col(url).alias("url"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    firsts = rows.groupBy("sha1").agg(F.min("id").alias("first"))
    typed = rows.join(firsts, "sha1").withColumn("revisit", (F.octet_length("payload") >= least_revisit) & ~F.col("id").eqNullSafe(F.col("first")))
    typed = typed.select(F.col("id").cast("string"), "url", "payload", F.unhex("sha1").alias("sha1"), F.col("first").cast("string"), "revisit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            index: list[dict] = []
            small = (batch.column(c).to_pylist() for c in ("id", "url", "sha1", "first", "revisit"))
            for r_id, r_url, sha1, first, revisit, body in zip(*small, (x.as_py() for x in batch.column("payload")), strict=True):
                if out is None:
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                digest = base64.b32encode(sha1).decode()
                data = record(r_id, r_url, body, digest, first, revisit, date)
                out.write(data)
                index.append({"id": r_id, "url": r_url, "payload_digest": digest, "record_type": "revisit" if revisit else "response", "file": f"{folder}/{name}", "offset": at, "length": len(data)})
                at += len(data)
                if at >= file_bytes:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_pylist(index, _INDEX_ARROW)
        if out is not None:
            out.close()

    return materialize(typed.mapInArrow(run, INDEX), "warc-index")


_INDEX_ARROW = pa.schema([("id", pa.string()), ("url", pa.string()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
_RECORD_ARROW = pa.schema([("id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def coalesce_ranges(parts: list[tuple[int, int]], max_gap: int) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Sorted (offset, length) pairs to reads: (start, stop, parts inside)."""
    reads: list[tuple[int, int, list[tuple[int, int]]]] = []
    for offset, length in sorted(parts):
        if reads and offset - reads[-1][1] <= max_gap:
            start, stop, inside = reads[-1]
            inside.append((offset, length))
            reads[-1] = start, max(stop, offset + length), inside
        else:
            reads.append((offset, offset + length, [(offset, length)]))
    return reads


def read_records(index: DataFrame, *, payload: bool = True, max_gap: int = MAX_GAP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The records that the rows of ``index`` (any selection) name."""
    block = F.floor(F.col("offset") / block_bytes)
    plan = index.groupBy("file", block.alias("block")).agg(F.collect_list(F.struct("offset", "length")).alias("parts"))
    # A plan row is small but stands for a block to read.  It is dealt by another expression than it was
    # grouped by, or the optimizer would drop the exchange and merge the tasks by the plan's bytes.
    plan = plan.repartition(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("file", "block", F.lit("read")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, parts in zip(batch.column("file").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                store, path = fs.FileSystem.from_uri(name)
                with store.open_input_file(path) as f:
                    for start, stop, inside in coalesce_ranges([(p["offset"], p["length"]) for p in parts], max_gap):
                        data = f.read_at(stop - start, start)
                        found = [parse_record(data[o - start : o - start + n]) for o, n in inside]
                        yield pa.RecordBatch.from_pylist(found if payload else [r | {"payload": None} for r in found], _RECORD_ARROW)

    return plan.select("file", "parts").mapInArrow(run, RECORD)


def op1_warc(spark, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back; null pages are empty payloads."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    read = read_records(write_archives(pages, "page_id", "url", "html"), payload=False)
    return read.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def _base32(h: str) -> str:
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    group = lambda g: f"cast('0x' || substr({h}, {5 * g + 1}, 5) AS bigint)"
    return " || ".join(f"substr({letters}, cast(({group(g)} >> {s}) & 31 AS integer) + 1, 1)" for g in range(8) for s in (15, 10, 5, 0))


OP1_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, {_base32('p.h')} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN f ON p.h = f.h
"""
