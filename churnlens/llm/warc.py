"""WARC archives: a writer with payload deduplication and a splittable reader."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEDUP_BYTES = 1000                # payloads below are always stored in full
SPLIT_BYTES = 8 * 1024 * 1024     # byte range of one reader task
CHUNK_BYTES = 1024 * 1024         # bytes fetched at a time
DATE = "1970-01-01T00:00:00Z"     # the tables hold no capture time
GZIP_MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
EMPTY_MEMBER = zlib.compressobj(9, zlib.DEFLATED, 31).flush()
RECORD = ("page_id long, url string, record_type string, refers_to long, payload_digest string, "
          "payload_bytes long, payload binary, archive string, offset long")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.0 record as a gzip member.  A revisit keeps the HTTP header, not the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if refers_to is None else http
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Date", DATE)]
    if page_id is not None:
        fields.append(("WARC-Record-ID", f"<urn:page:{page_id}>"))
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(head.encode() + block + b"\r\n\r\n") + gz.flush()


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, refers_to of the records to write.

    Equal payloads of 1000 bytes or more: those with the largest page_id are
    stored, all others point to it.  The groups are found by an aggregate of
    digests (map-side combined), and only groups of several pages are joined
    back, so a payload of a third of all pages costs one row per map task.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).select(
        "page_id", "url", "payload", F.sha1("payload").alias("digest"),
        F.octet_length("payload").cast("long").alias("bytes"))
    groups = (rows.where(f"bytes >= {DEDUP_BYTES} and page_id is not null").groupBy("digest", "bytes")
              .agg(F.max("page_id").alias("kept_id"), F.min("page_id").alias("least_id"))
              .where("least_id < kept_id").drop("least_id"))
    return (rows.join(groups, ["digest", "bytes"], "left")
            .select("page_id", "url", "payload", "digest",
                    F.when(F.col("page_id") < F.col("kept_id"), F.col("kept_id")).alias("refers_to")))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write every page as a record of gzip archives under ``path``.

    The bytes go through Spark's text sink, so any file system works and a
    retried or speculative task cannot leave half an archive behind.  The sink
    needs a separator between rows: it is an empty gzip member, which any gzip
    reader passes over.
    """
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512).to_pydict()
                yield pa.RecordBatch.from_arrays([pa.array(
                    [record(*row) for row in zip(part["page_id"], part["url"], part["payload"], part["digest"],
                                                 part["refers_to"])], pa.binary())], ["member"])

    (with_revisits(pages).mapInArrow(members, "member binary").select(F.col("member").cast("string"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path))


def parse(raw: bytes) -> tuple | None:
    """Columns of a decoded record (None for records that hold no page, such as warcinfo)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = len(payload)
    if kind == "revisit":
        payload = None
        for line in http.split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length":
                length = int(value)

    def page(name):
        uri = fields.get(name, "")
        return int(uri[len("<urn:page:"):-1]) if uri.startswith("<urn:page:") else None

    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    return (page("warc-record-id"), fields.get("warc-target-uri"), kind, page("warc-refers-to"), digest, length,
            payload)


def members(source, size: int, start: int, end: int, chunk: int = CHUNK_BYTES) -> Iterator[tuple[int, bytes]]:
    """(offset, decoded bytes) of the gzip members that begin in [start, end).

    ``source`` has seek and read.  Every gzip magic in the range is a candidate; one
    that does not decode, or whose first bytes are not a WARC header, is chance
    bytes inside a member and the search goes on behind it.  The last member
    is read beyond ``end`` to its own end.  A record that starts well but breaks off
    raises, so a damaged archive is never read as a shorter one.
    """
    source.seek(start)
    buffer, base = b"", start  # buffer holds the bytes from base on

    def more() -> bool:
        nonlocal buffer
        got = source.read(chunk) if base + len(buffer) < size else b""
        buffer += got
        return bool(got)

    at = start
    while at < end:
        found = buffer.find(GZIP_MAGIC, at - base)
        if found < 0:
            at = max(at, base + len(buffer) - len(GZIP_MAGIC) + 1)
            buffer, base = buffer[at - base:], at
            if not more():
                return
            continue
        at = base + found
        if at >= end:
            return
        buffer, base = buffer[found:], at
        gz, out, fed, warc = zlib.decompressobj(31), [], 0, False
        total = 0
        try:
            while not gz.eof:
                if fed == len(buffer) and not more():
                    break
                piece = gz.decompress(buffer[fed:])
                fed = len(buffer)
                out.append(piece)
                total += len(piece)
                if not warc and total >= 5:
                    warc = b"".join(out).startswith(b"WARC/")
                    if not warc:
                        break
        except zlib.error:
            if warc:
                raise
        if not gz.eof and warc:
            raise EOFError(f"a record at byte {at} breaks off")
        if not gz.eof or (total and not warc):
            at += 1
            continue
        after = at + fed - len(gz.unused_data)
        if total:
            yield at, b"".join(out)
        at = after


def _open(uri: str):
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    system, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return system.open_input_file(path)


def read_archives(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Read the page records of all archives under ``path``.

    Files are listed by Spark and cut into byte ranges; each range is a task that
    owns the records starting inside it.  An archive of any size is thus read
    by many tasks.  Files without a record, and an empty folder, give no rows.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    ranges = files.select("path", "length", F.explode(
        F.sequence(F.lit(0), F.col("length") - 1, F.lit(split_bytes))).alias("start"))
    ranges = ranges.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, length, start in zip(*(c.to_pylist() for c in batch.columns)):
                with _open(uri) as source:
                    rows, held = [], 0
                    for offset, raw in members(source, length, start, min(start + split_bytes, length)):
                        row = parse(raw)
                        if row:
                            rows.append((*row, uri, offset))
                            held += len(raw)
                        if held > 4 * CHUNK_BYTES:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    return ranges.mapInArrow(run, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string(),
             pa.int64()]
    names = [c.split()[0] for c in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def round_trip(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html; other columns are ignored) as archives under
    ``path`` and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    One row per input row.  NULL html is an empty payload, a NULL url is left out
    of the record, a NULL page_id neither revisits nor is revisited.  Rows that
    repeat the largest page_id of a group are responses all.  A response's digest is
    computed from the payload as read back.
    """
    write_archives(pages, path)
    back = read_archives(pages.sparkSession, path)
    digest = F.when(F.col("record_type") == "response", F.sha1("payload")).otherwise(F.col("payload_digest"))
    return back.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")
