"""WARC archives: a writer with revisit records, and a splittable reader.

Archives are gzip files of one member per record, the form in which a file can
be read from any place.  The reader cuts every archive into byte ranges, one a
task.  A task scans its range for the gzip magic, takes a place as a member if
what inflates there starts with a whole WARC header, and owns the records that
*start* inside its range, reading on past the end of the range for the last.

A payload may hold something that looks like a member (an archive stored in an
archive).  Only a range that starts inside such a payload can fall for it, and
then its first record starts before the record of the range ahead has ended.
The ranges of every file are checked for that, and such a range is read again
from where the record ahead ends.

Archives are written from the tasks straight into the shared folder; the
returned list of files names those of finished tasks only, so a task that is
run again leaves a stray file that nobody reads.  Payloads are held one at a
time; members are inflated in blocks, so without ``with_payload`` the reader's
memory does not grow with a record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import pick, save

ARCHIVE_BYTES = 256 << 20      # a new archive is begun beyond this size
SPLIT_BYTES = 64 << 20         # byte range of one reading task
BLOCK = 1 << 20
HEADER_BYTES = 1 << 20         # a WARC header longer than this is none
DATE = "2000-01-01T00:00:00Z"
MAGIC = b"\x1f\x8b\x08"
FILES = "path string, length long, records long"
RECORDS = ("path string, range_start long, range_stop long, offset long, next_offset long, record_type string, "
           "record_id string, refers_to string, target_uri string, payload_bytes long, payload_digest string, "
           "digest_ok boolean, payload binary")


def _open(path: str, write: bool = False):
    """A file of any store that pyarrow reaches (file, hdfs, s3, gs ...)."""
    store, at = pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    if not write:
        return store.open_input_file(at)
    store.create_dir(at.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(at, compression=None)


# ------------------------------------------------------------------ writing
def _member(out, head: bytes, body: bytes) -> None:
    """One gzip member holding ``head``, ``body`` and the end of the record."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    out.write(z.compress(head))
    for at in range(0, len(body), BLOCK):
        out.write(z.compress(memoryview(body)[at:at + BLOCK]))
    out.write(z.compress(b"\r\n\r\n"))
    out.write(z.flush())


def _uri(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", text)


def _head(ident: str, url: str | None, n_bytes: int, digest: str, refers: str | None) -> bytes:
    """WARC and HTTP headers of a record; a revisit's block ends with them."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n"
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <{_uri(ident)}>",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(http) + (n_bytes if refers is None else 0)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    if refers is not None:
        lines += [f"WARC-Refers-To: <{_uri(refers)}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def write_archives(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row; (path, length, records) of the archives.

    Of rows with equal payloads (by SHA-1) of ``min_bytes`` or more, that with
    the smallest id is a response and the others revisits of it, without the
    payload.  A null payload is empty (text goes in as UTF-8); a null url
    leaves the header line out, blanks and control characters in a url or id are written as
    %XX; ``urn:page:`` and the id name a record.  Rows without id come after
    all ids: they revisit, or are all responses where no row has one; rows that
    repeat the smallest id are all responses.  No rows: no archives.
    """
    spark = pages.sparkSession
    folder = path or scratch_path(spark, "warc")
    rows = pick(pages, id=id_col, url=url_col, payload=payload_col)
    rows = rows.select("id", F.col("url").cast("string").alias("url"),
                       F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    first = (rows.where(F.octet_length("payload") >= min_bytes).groupBy("sha")
             .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL").drop("n"))
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    rows = rows.join(first, "sha", "left").select(
        F.concat(F.lit("urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("ident"), "url",
        F.when(~again, F.col("payload")).alias("payload"), F.octet_length("payload").cast("long").alias("n_bytes"), "sha",
        F.when(again, F.concat(F.lit("urn:page:"), F.col("first").cast("string"))).alias("refers"))

    def write(batches) -> Iterator[pa.RecordBatch]:
        task, done, out = TaskContext.get().partitionId(), [], None
        for b in batches:
            for ident, url, payload, n, sha, refers in zip(*b.columns):
                if out is None:
                    name, count = f"{folder}/part-{task:05d}-{uuid.uuid4().hex[:12]}.warc.gz", 0
                    out = _open(name, write=True)
                digest = base64.b32encode(sha.as_py()).decode()
                _member(out, _head(ident.as_py(), url.as_py(), n.as_py(), digest, refers.as_py()), payload.as_py() or b"")
                count += 1
                if out.tell() >= archive_bytes:
                    done.append((name, out.tell(), count))
                    out.close()
                    out = None
        if out is not None:
            done.append((name, out.tell(), count))
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
                                          pa.array([d[2] for d in done], pa.int64())], ["path", "length", "records"])

    return save(rows.mapInArrow(write, FILES), "warc-files")


# ------------------------------------------------------------------ reading
class _Member:
    """Inflates the gzip member at ``offset``, block by block."""

    def __init__(self, f, offset: int):
        f.seek(offset)
        self.f, self.at, self.z, self.held = f, offset, zlib.decompressobj(31), b""

    def more(self) -> bool:
        """Inflate one more block into ``held``; False at the member's end."""
        while not self.z.eof:
            data = self.z.unconsumed_tail
            if not data:
                data = self.f.read(BLOCK if self.at else 1 << 16)
                self.at += len(data)
                if not data:
                    raise EOFError("archive ends inside a record")
            out = self.z.decompress(data, BLOCK)
            if out:
                self.held += out
                return True
        return False

    def end(self) -> int:
        return self.at - len(self.z.unused_data)

    def until(self, mark: bytes, limit: int) -> bytes | None:
        """Everything up to ``mark`` (dropped), or None if it does not come."""
        while (k := self.held.find(mark)) < 0:
            if len(self.held) > limit or not self.more():
                return None
        out, self.held = self.held[:k], self.held[k + len(mark):]
        return out

    def blocks(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in blocks."""
        while n:
            if not self.held and not self.more():
                raise EOFError("record is shorter than its Content-Length")
            out, self.held = self.held[:n], self.held[n:]
            n -= len(out)
            yield out


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (x.partition(":") for x in lines.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _magic(f, at: int, stop: int) -> int | None:
    """First place in [at, stop) where the gzip magic stands."""
    held, base = b"", at
    f.seek(at)
    while base < stop:
        data = f.read(min(BLOCK, stop + 2 - base - len(held)))
        held += data
        k = held.find(MAGIC)
        if 0 <= k and base + k < stop:
            return base + k
        if not data:
            return None
        base, held = base + max(0, len(held) - 2), held[-2:]
    return None


def _record(f, at: int, with_payload: bool) -> tuple | None:
    """(next offset, type, id, refers to, uri, bytes, digest, digest holds, payload) of the
    record at ``at``; None if no member with a WARC header starts there."""
    m = _Member(f, at)
    try:
        if not m.more() or not m.held.startswith(b"WARC/1."[:len(m.held)]):
            return None
        head = m.until(b"\r\n\r\n", HEADER_BYTES)
        if head is None or not head.startswith(b"WARC/1."):
            return None
        h = _fields(head)
        length = int(h["content-length"])
    except (zlib.error, EOFError, KeyError, ValueError):
        return None
    # from here on it is a record: damage inside it is an error, not another place to look
    sha, n, kept, http = hashlib.sha1(), 0, [], {}
    if "msgtype=response" in h.get("content-type", ""):
        lines = m.until(b"\r\n\r\n", HEADER_BYTES)
        if lines is None:
            raise ValueError(f"no end of the HTTP header in the record at {at}")
        http, length = _fields(lines), length - len(lines) - 4
    for block in m.blocks(length):
        sha.update(block)
        n += len(block)
        if with_payload:
            kept.append(block)
    while m.more():
        m.held = m.held[-4:]
    digest, said = base64.b32encode(sha.digest()).decode(), h.get("warc-payload-digest", "").removeprefix("sha1:") or None
    revisit = h.get("warc-type") == "revisit"
    if revisit:
        n, digest = int(http["content-length"]) if http.get("content-length", "").isdigit() else None, said
    bare = lambda x: x and x.strip("<>")                                # noqa: E731
    return (m.end(), h.get("warc-type"), bare(h.get("warc-record-id")), bare(h.get("warc-refers-to")), h.get("warc-target-uri"),
            n, digest, None if revisit or said is None else said == digest,
            b"".join(kept) if with_payload and not revisit else None)


def _read(ranges: DataFrame, n: int, with_payload: bool) -> DataFrame:
    """Records of ranges (path, range_start, range_stop, begin), and one row
    without record type per range: offset of its first record, end of its last."""
    def scan(batches):
        schema = pa.schema([("path", pa.string()), *[(c, pa.int64()) for c in ("range_start", "range_stop", "offset", "next_offset")],
                            *[(c, pa.string()) for c in ("record_type", "record_id", "refers_to", "target_uri")],
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_ok", pa.bool_()),
                            ("payload", pa.binary())])
        rows, weight = [], 0
        for b in batches:
            for path, start, stop, begin in zip(*(c.to_pylist() for c in b.columns)):
                first = last = None
                with _open(path) as f:
                    at = _magic(f, begin, stop)
                    while at is not None:
                        found = _record(f, at, with_payload)
                        if found is None:
                            at = _magic(f, at + 1, stop)
                            continue
                        rows.append((path, start, stop, at, *found))
                        weight += 400 + len(found[-1] or b"")
                        first, last = at if first is None else first, found[0]
                        if weight > 8 << 20:
                            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
                            rows, weight = [], 0
                        at = _magic(f, last, stop)
                rows.append((path, start, stop, first, last, *[None] * 8))
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

    return ranges.repartition(max(1, n)).mapInArrow(scan, RECORDS)


def archives(spark: SparkSession, glob: str) -> DataFrame:
    """(path, length) of the files that match, listed by Spark without reading them."""
    return spark.read.format("binaryFile").load(glob).select("path", "length")


def read_archives(files: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = False) -> DataFrame:
    """Every record of the archives (path, length), read by byte ranges.

    Result: path, offset, next_offset, record_type, record_id, refers_to,
    target_uri, payload_bytes and payload_digest (bare base32 SHA-1; of a
    revisit what its headers say of the full payload), digest_ok (payload agrees
    with the header; null if there is nothing to compare), payload (null unless
    asked for).  A record whose header is whole but whose body is damaged or
    cut off ends the job; bytes between members are skipped.  No files: no rows.
    """
    spark = files.sparkSession
    ranges = (files.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long")))
                                               .alias("range_start"))
              .select("path", "range_start", F.least(F.col("range_start") + split_bytes, "length").alias("range_stop"),
                      F.col("range_start").alias("begin")))
    n = files.where("length > 0").agg(F.sum(F.ceil(F.col("length") / split_bytes))).first()[0]
    width = min(int(n or 0), 100_000)
    found = save(_read(ranges, width, with_payload), "warc-records")
    while True:
        ends = found.where("record_type IS NULL").select("path", "range_start", "range_stop", "offset", "next_offset")
        ahead = Window.partitionBy("path").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
        wrong = (ends.withColumn("begin", F.max("next_offset").over(ahead)).where("offset < begin")
                 .groupBy("path").agg(F.min(F.struct("range_start", "range_stop", "begin")).alias("r"))
                 .select("path", "r.*"))
        wrong = save(wrong, "warc-wrong")                  # the first such range of each file
        if wrong.isEmpty():
            return found.where("record_type IS NOT NULL").drop("range_start", "range_stop")
        rest = found.join(wrong.select("path", "range_start"), ["path", "range_start"], "left_anti").select(*found.columns)
        found = save(rest.unionByName(_read(wrong, min(wrong.count(), 100_000), with_payload)), "warc-records")


def page_records(pages: DataFrame, split_bytes: int = SPLIT_BYTES, **how) -> DataFrame:
    """Write ``pages`` and read them back: page_id, payload_bytes, payload_digest,
    record_type, refers_to per row (ids as the type of ``page_id``)."""
    kind = pages.schema[how.get("id_col", "page_id")].dataType
    records = read_archives(write_archives(pages, **how), split_bytes)
    ident = lambda c: F.nullif(F.substring(c, len("urn:page:") + 1, 1 << 20), F.lit("")).cast(kind)     # noqa: E731
    return records.select(ident("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          ident("refers_to").alias("refers_to"))
