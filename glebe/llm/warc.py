"""WARC archives: a writer with revisit records, and a splittable reader of gzipped WARC files.

Writer. Every row becomes one record in a gzip member of its own. Of records with equal payloads the one with
the smallest id is a ``response``, the others are ``revisit`` records that name it and hold no payload. Each
task writes one archive under a name of its attempt and returns a manifest row; Spark keeps the rows of
successful attempts only, so archives that a lost executor left behind are never listed.

Reader. Archives are cut into byte ranges. A task searches its range for the gzip magic, takes a position for
a member only if its first bytes inflate to the start of a WARC header, if the whole member inflates with a
right checksum, and if its size is that of the header, however long, plus the length the header gives. It owns
the records that start inside its range, reads the last one past the range's end, and follows a record by what
stands right behind it. :func:`round_trip` counts the records of every archive against its manifest row.
Executors open archives through pyarrow's file systems (``file``, ``hdfs``, ``s3`` and others).

Defined results:
  null html      the empty payload
  null url       no WARC-Target-URI
  null page_id   larger than every id; in a group of null ids alone one record is the response
  repeated rows  the same page_id and payload again is a revisit
  payloads below ``least_bytes``   always response
  empty table    no archive, empty result
  bytes that are no valid member   skipped up to the next valid one
  extra columns  not written
"""

from __future__ import annotations

import hashlib
import re
import zlib
from base64 import b32encode
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glebe.llm.staging import staged
from glebe.session import scratch_path

GZIP_MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE_DATE = "2024-01-01T00:00:00Z"
LEVEL = 6
SPLIT_BYTES = 4 << 20
# Ranges of a reading, while they need not be larger than LARGEST_SPLIT.
RANGES = 10_000
LARGEST_SPLIT = 256 << 20
READ_BYTES = 1 << 20
# So many inflated bytes are looked at before a whole member is inflated.
HEADER_BYTES = 1 << 16
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20

MANIFEST = "path string, bytes long, records long"
RECORD = "path string, offset long, record_type string, page_id long, target_uri string, payload_bytes long, payload_digest string, refers_to long, payload binary"
RECORD_ARROW = pa.schema([
    ("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64()), ("target_uri", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI (or plain path) and the path on it."""
    if urlsplit(uri).scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(urlsplit(uri).path)
    return pafs.FileSystem.from_uri(uri)


def digest(payload: bytes) -> str:
    return b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record_id(page_id: int | None, uid: int) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{uid}>"


def page_of(identifier: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+):\d+>", identifier or "")
    return int(found[1]) if found else None


def encode(page_id: int | None, uid: int, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode("ascii")
    block = http if refers_to else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: {record_id(page_id, uid)}", f"WARC-Date: {CAPTURE_DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to:
        head += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {PROFILE}"]
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return deflate.compress("\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n") + deflate.flush()


def with_referrals(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``pages`` (staged: _uid, page_id, url, html) with the record that an equal, smaller one refers to (else null)."""
    last = (1 << 63) - 1
    payload = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.withColumn("_sha", F.sha2(payload.cast("binary"), 256))
    groups = keyed.where(F.octet_length(payload) >= least_bytes).groupBy("_sha").agg(
        F.count(F.lit(1)).alias("_n"), F.min("page_id").alias("_first_id"), F.min_by("_uid", F.coalesce("page_id", F.lit(last))).alias("_first_uid")
    )
    # Texts that occur once need no partner; what is left is staged, so a hot payload's partition can be split.
    repeated = staged(groups.where("_n > 1").drop("_n"), "warc-repeated")
    refers = F.when(F.col("_first_uid").isNotNull() & (F.col("_first_uid") != F.col("_uid")),
                    F.concat_ws(":", F.lit("<urn:page"), F.coalesce(F.col("_first_id").cast("string"), F.lit("")), F.concat(F.col("_first_uid").cast("string"), F.lit(">"))))
    return keyed.join(repeated, "_sha", "left").select("_uid", "page_id", "url", "html", refers.alias("refers_to"))


def write_archives(pages: DataFrame, directory: str, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as gzipped WARC files below ``directory``; returns the manifest (staged)."""
    rows = pages.select("page_id", "url", "html").withColumn("_uid", F.monotonically_increasing_id())
    rows = with_referrals(staged(rows, "warc-pages"), least_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(directory)
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}.warc.gz"
        out, size, records = None, 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                member = encode(row["page_id"], row["_uid"], row["url"], (row["html"] or "").encode("utf-8"), row["refers_to"])
                out.write(member)
                size, records = size + len(member), records + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{directory}/{name}"], "bytes": [size], "records": [records]})

    return staged(rows.mapInArrow(write, MANIFEST), "warc-manifest")


def _inflate(source, at: int, most: int | None) -> tuple[bytes, int, bool]:
    """Inflate the gzip member at byte ``at``: (data, end of the member, complete). Stops after ``most`` bytes. Raises zlib.error."""
    inflate, parts, got = zlib.decompressobj(31), [], 0
    while not inflate.eof:
        source.seek(at)
        piece = source.read(READ_BYTES if most is None else HEADER_BYTES)
        if not piece:
            return b"".join(parts), at, False
        while piece and not inflate.eof:
            data = inflate.decompress(piece, READ_BYTES)
            parts.append(data)
            got += len(data)
            rest = inflate.unconsumed_tail
            at += len(piece) - len(rest) - len(inflate.unused_data)
            if most is not None and got >= most:
                return b"".join(parts), at, False
            if not data and len(rest) == len(piece):
                raise zlib.error("no progress")
            piece = rest
    return b"".join(parts), at, True


def _header(data: bytes) -> tuple[dict[str, str], int] | None:
    """The fields of a WARC header (names lower-cased) and its length with the empty line; None if it is none."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(b"WARC/") or end < 0:
        return None
    lines = data[:end].decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return (fields, end + 4) if fields.get("content-length", "").isdigit() else None


def member_at(source, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """(fields, block, end) of the record whose gzip member starts at ``at``; None if no valid one does."""
    try:
        first = _inflate(source, at, HEADER_BYTES)[0]
        # A header that goes on behind these bytes is judged by the whole member.
        if not first.startswith(b"WARC/") or (b"\r\n\r\n" in first and _header(first) is None):
            return None
        data, end, complete = _inflate(source, at, None)
    except zlib.error:
        return None
    found = _header(data) if complete else None
    if found is None or found[1] + int(found[0]["content-length"]) + 4 != len(data):
        return None
    return found[0], data[found[1]:-4], end


def _next_magic(source, at: int, end: int) -> int:
    """The first position of the gzip magic in [at, end), or -1; the magic itself may reach past ``end``."""
    while at < end:
        source.seek(at)
        piece = source.read(min(READ_BYTES, end - at) + len(GZIP_MAGIC) - 1)
        found = piece.find(GZIP_MAGIC)
        if found >= 0:
            return at + found
        if len(piece) < len(GZIP_MAGIC):
            return -1
        at += len(piece) - len(GZIP_MAGIC) + 1
    return -1


def records_in(source, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, fields, block) of the records that start in [start, end)."""
    at = start
    while (at := _next_magic(source, at, end)) >= 0:
        found = member_at(source, at)
        if found is None:
            at += 1
            continue
        yield at, found[0], found[1]
        at = found[2]


def _row(path: str, offset: int, fields: dict[str, str], block: bytes, keep_payload: bool) -> tuple:
    head, gap, payload = block.partition(b"\r\n\r\n")
    kind = fields.get("warc-type")
    if kind == "revisit":
        sizes = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        told = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        return (path, offset, kind, page_of(fields.get("warc-record-id")), fields.get("warc-target-uri"), int(sizes[1]) if sizes else None, told,
                page_of(fields.get("warc-refers-to")), None)
    payload = payload if gap else block
    return (path, offset, kind, page_of(fields.get("warc-record-id")), fields.get("warc-target-uri"), len(payload), digest(payload), None,
            payload if keep_payload else None)


def range_bytes(total: int) -> int:
    """Bytes of a range: SPLIT_BYTES, more where that would be over RANGES ranges, and LARGEST_SPLIT at most."""
    return min(LARGEST_SPLIT, max(SPLIT_BYTES, -(-total // RANGES)))


def splits(manifest: DataFrame, split_bytes: int) -> DataFrame:
    """(path, start, end): the byte ranges of the archives in ``manifest`` (path, bytes)."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long")))
    return manifest.where("bytes > 0").select("path", starts.alias("start"), "bytes").select("path", "start", F.least(F.col("start") + split_bytes, "bytes").alias("end"))


def read_archives(manifest: DataFrame, split_bytes: int | None = None, keep_payload: bool = True) -> DataFrame:
    """All records of the archives in ``manifest`` (path, bytes), with the columns of :data:`RECORD`."""
    if split_bytes is None:
        split_bytes = range_bytes(manifest.agg(F.sum("bytes")).first()[0] or 0)
    ranges = splits(manifest, split_bytes)
    partitions = max(1, ranges.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for split in batch.to_pylist():
                fs, path = file_system(split["path"])
                with fs.open_input_file(path) as source:
                    for offset, fields, block in records_in(source, split["start"], split["end"]):
                        rows.append(_row(split["path"], offset, fields, block, keep_payload))
                        held += len(block) if keep_payload else 0
                        if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                            yield _batch(rows)
                            rows, held = [], 0
        if rows:
            yield _batch(rows)

    return ranges.repartition(partitions).mapInArrow(read, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), RECORD_ARROW.types)], schema=RECORD_ARROW)


def counted(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """``records`` (staged) as they are; raises if an archive gave another number of them than its manifest row says."""
    read = records.groupBy(F.col("path").alias("_path")).agg(F.count(F.lit(1)).alias("_read"))
    told = manifest.join(read, F.col("path") == F.col("_path"), "left").withColumn("_read", F.coalesce("_read", F.lit(0)))
    wrong = told.where(F.col("_read") != F.col("records")).select("path", "records", "_read").first()
    if wrong is not None:
        raise ValueError(f"{wrong['path']} holds {wrong['records']} records, {wrong['_read']} were read")
    return records


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    manifest = write_archives(pages, scratch_path(pages.sparkSession, "llm-warc"), least_bytes)
    wanted = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    records = staged(read_archives(manifest, keep_payload=False).select("path", *wanted), "warc-records")
    return counted(records, manifest).select(*wanted)
