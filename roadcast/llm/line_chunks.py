"""Operator 6: line deduplication by content-defined chunks of lines.

A text's lines are cut into chunks where a rolling hash over the hashes of the
last ``WINDOW`` lines hits a fixed residue, so a shared passage is cut alike
wherever it stands in a document.  A chunk of several lines that occurs
earlier in the corpus (smaller id, or same document and earlier) is removed
after its bytes compared equal to the first occurrence; chunks of one line and
chunks shorter than ``least`` bytes stay.

That rule alone sees a repeat only where whole chunks lie inside the shared
passage.  With ``runs`` (what the query and the pipeline use) the boundaries
are finer and only find the places to look at: a line is a boundary where its
hash is the least of a rolling window of ``WINDOW`` lines (``boundaries``), so
the lines from one boundary to the next are at most ``WINDOW`` and any run of
that many lines holds a boundary chosen by its own lines alone.  Boundaries
whose hash repeats in the corpus are then grown line by line: every shortest
run of ``WINDOW`` lines and ``least`` bytes around one (``windows``) that occurs
earlier goes after its bytes compared equal.  Joined where they overlap, the
removed bytes are exactly the maximal repeated runs of two lines and ``least``
bytes or more; no window away from a repeated boundary is hashed.

Hashes meet first (a row per boundary, then per window, no text); only chunks
whose hash repeats are cut out of the texts again for the comparison, found by
filters of bounded size in a scan that shuffles no whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_filter, in_filter, row_key, save, utf8

WINDOW = 2
MEAN_LINES = 4
MOST_LINES = 64
LEAST_BYTES = 32
_MASK = (1 << 64) - 1
_TURN = 0x9E3779B97F4A7C15


def line_chunks(text: bytes, mean: int = MEAN_LINES, most: int = MOST_LINES) -> list[tuple[int, int, int]]:
    """(start, end, lines) of the chunks; a chunk's last newline belongs to it."""
    out, start, end, lines, last = [], 0, 0, 0, 0
    for line in text.split(b"\n"):
        end += len(line) + 1
        lines += 1
        h = xxhash.xxh3_64_intdigest(line)
        # the rolling hash covers this line and the one before it
        roll = (h + last * _TURN) & _MASK
        last = h
        if lines >= WINDOW and (roll >> 32) % mean == 0 or lines >= most:
            out.append((start, min(end, len(text)), lines))
            start, lines = end, 0
    if lines and start < len(text):
        out.append((start, len(text), lines))
    return out


def _hashed(text: bytes, least: int):
    """(start, end, lines, two hashes) of the chunks that may be removed."""
    for s, e, n in line_chunks(text):
        body = text[s:e].rstrip(b"\n")          # the same passage may end a text without a newline
        if n > 1 and len(body) >= least:
            d = xxhash.xxh3_128_digest(body)
            yield s, e, n, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), body


def _lines(text: bytes) -> tuple[list[int], list[int]]:
    """Starts and ends of the lines, newlines apart.  The nothing after a text's
    last newline is no line."""
    start, stop, at = [], [], 0
    for line in text.split(b"\n"):
        start.append(at)
        stop.append(at + len(line))
        at += len(line) + 1
    if len(start) > 1 and start[-1] == stop[-1]:
        del start[-1], stop[-1]
    return start, stop


def boundaries(text: bytes, least: int = LEAST_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, hashes) of the lines whose hash is the least of a window of
    ``WINDOW`` lines they are in.  Lines that fill their share of ``least`` come
    before shorter ones, so blank lines are chosen among blank lines only."""
    start, stop = _lines(text)
    n = len(start)
    if n < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    view = memoryview(text)
    h = np.array([xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(start, stop)], dtype=np.uint64)
    short = np.subtract(stop, start) < least // WINDOW
    h = (h >> np.uint64(1)) | (short.astype(np.uint64) << np.uint64(63))
    rolled = np.lib.stride_tricks.sliding_window_view(h, WINDOW)
    low = rolled.min(axis=1)
    chosen = np.zeros(n, dtype=bool)
    for k in range(WINDOW):
        chosen[k:n - WINDOW + 1 + k] |= rolled[:, k] == low
    at = np.flatnonzero(chosen)
    return at, h[at]


def windows(text: bytes, least: int = LEAST_BYTES, near: np.ndarray | None = None) -> list[tuple[int, int, int, int]]:
    """(start, end, lines, end without the last newline) of the shortest runs of
    at least ``WINDOW`` lines and ``least`` bytes, from each line and up to each
    line; with ``near``, of those that hold one of these lines."""
    start, stop = _lines(text)
    n, found, j = len(start), set(), 0
    for i in range(n):
        j = max(j, i + WINDOW - 1)
        while j < n and stop[j] - start[i] < least:
            j += 1
        if j >= n:
            break
        found.add((i, j))
    i = n - 1
    for j in range(n - 1, -1, -1):
        i = min(i, j - WINDOW + 1)
        while i >= 0 and stop[j] - start[i] < least:
            i -= 1
        if i < 0:
            break
        found.add((i, j))
    if near is not None:
        upto = np.zeros(n + 1, dtype=np.int64)
        upto[np.asarray(near, dtype=np.int64) + 1] = 1
        upto = np.cumsum(upto).tolist()
        found = {(i, j) for i, j in found if upto[j + 1] > upto[i]}
    return [(start[i], start[j + 1] if j + 1 < n else len(text), j - i + 1, stop[j]) for i, j in sorted(found)]


def _hashed_windows(text: bytes, least: int, repeated: np.ndarray):
    """As ``_hashed``, for the windows around boundaries that the filter ``repeated`` lets through."""
    at, h = boundaries(text, least)
    if at.size:
        at = at[in_filter(repeated, h)]
    if not at.size:
        return
    for s, e, n, stop in windows(text, least, at):
        body = text[s:stop]
        d = xxhash.xxh3_128_digest(body)
        yield s, e, n, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), body


def _filter_of(df: DataFrame, col: str) -> np.ndarray:
    """Filter of a column's values: 16 bits for each, 1 MB at least and 16 MB at
    most.  Beyond 8 million values it lets more through; exact joins follow."""
    return bounded_filter(df, col, 1 << min(27, max(23, (16 * df.count() - 1).bit_length())))


def _repeated_boundaries(rows: DataFrame, least: int) -> DataFrame:
    """Column h: hashes of boundaries that occur more than once in the corpus."""
    def scan(batches):
        for b in batches:
            found = [boundaries(t.as_py(), least)[1] for t in b.column(0)]
            h, times = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(times.astype(np.int64))], ["h", "times"])

    times = rows.select("text").mapInArrow(scan, "h long, times long").groupBy("h").agg(F.sum("times").alias("times"))
    return save(times.where("times > 1").select("h"), "lines-boundaries")


_CHUNK = "array<struct<s:int,e:int,n:int,c1:long,c2:long>>"


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_BYTES,
               keep: tuple[str, ...] = (), runs: bool = False) -> DataFrame:
    """Row per input row: id, text without repeated chunks, n_lines, n_removed
    (lines), n_chunks (removed) and the ``keep`` columns.

    With ``runs``, all repeated runs of lines go and n_chunks counts them.

    A null text stays null (no lines, nothing removed); an empty text has one
    empty line.  Rows order by id, rows without one last; rows equal in id and
    text are one document and keep the same chunks.  An empty table gives an
    empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), *row_key(id_col, text_col), utf8(text_col).alias("text"))
    chunk = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("n", pa.int32()), ("c1", pa.int64()), ("c2", pa.int64())]))
    spark = docs.sparkSession
    edges = spark.sparkContext.broadcast(_filter_of(_repeated_boundaries(rows, least), "h")) if runs else None

    def hashed(text):
        return _hashed_windows(text, least, edges.value) if runs else _hashed(text, least)

    id_sql = rows.schema["id"].dataType.simpleString()

    def scan(batches):
        for b in batches:
            found = [[dict(zip(("s", "e", "n", "c1", "c2"), c)) for c in hashed(t.as_py())] for t in b.column(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(found, chunk)], ["id", "k1", "k2", "chunks"])

    scanned = save(rows.mapInArrow(scan, f"id {id_sql}, k1 long, k2 long, chunks {_CHUNK}").where(F.size("chunks") > 0), "lines-scan")
    each = scanned.select("id", "k1", "k2", F.explode("chunks").alias("c")).select("id", "k1", "k2", "c.*")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "s", "k1", "k2")
    repeated = save(each.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("first"))
                    .where("times > 1").select("c1", "c2", "first"), "lines-repeated")

    # the bytes of chunks whose hash repeats
    bitmap = spark.sparkContext.broadcast(_filter_of(repeated, "c1"))

    def cut(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            for k1, k2, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                got = list(hashed(t.as_py()))
                if got:
                    may = in_filter(bitmap.value, np.array([g[3] for g in got], dtype=np.int64).view(np.uint64))
                    for (s, e, n, c1, c2, body), ok in zip(got, may.tolist()):
                        if ok:
                            for col, v in zip(cols, (k1, k2, s, e, c1, c2, body)):
                                col.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["k1", "k2", "s", "e", "c1", "c2", "body"])

    some = save(rows.select("k1", "k2", "text").mapInArrow(cut, "k1 long, k2 long, s int, e int, c1 long, c2 long, body binary"),
                "lines-bytes")
    here = (F.col("k1") == F.col("first.k1")) & (F.col("k2") == F.col("first.k2")) & (F.col("s") == F.col("first.s"))
    occur = some.join(repeated, ["c1", "c2"])
    firsts = occur.where(here).groupBy("c1", "c2").agg(F.first("body").alias("first_body"))
    gone = (occur.where(~here).join(firsts, ["c1", "c2"]).where(F.col("body") == F.col("first_body"))
            .select("k1", "k2", "s", "e").distinct()
            .groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("gone")))

    full = docs.select(F.col(id_col).alias("id"), *row_key(id_col, text_col), F.col(text_col).cast("binary").alias("text"),
                       *[F.col(c).alias(f"keep_{c}") for c in keep]).join(gone, ["k1", "k2"], "left").drop("k1", "k2")
    kinds = dict(full.dtypes)

    def rebuild(batches):
        for b in batches:
            text, lines, less, chunks = [], [], [], []
            for t, g in zip(b.column("text"), b.column("gone")):
                t, g = t.as_py(), g.as_py() or []
                out, at, n, spans = [], 0, 0, []
                for r in g:                    # windows of one run overlap
                    if spans and r["s"] < spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r["e"])
                    else:
                        spans.append([r["s"], r["e"]])
                for s, e in spans:
                    out.append(t[at:s])
                    part = t[s:e]
                    n += part.count(b"\n") + (not part.endswith(b"\n"))
                    at = e
                text.append(None if t is None else (b"".join(out) + t[at:]).decode("utf-8", "replace"))
                lines.append(0 if t is None else t.count(b"\n") + 1)
                less.append(n)
                chunks.append(len(spans))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(text, pa.string()), pa.array(lines, pa.int64()), pa.array(less, pa.int64()),
                 pa.array(chunks, pa.int64()), *[b.column(f"keep_{c}") for c in keep]],
                ["id", "text", "n_lines", "n_removed", "n_chunks", *[f"keep_{c}" for c in keep]])

    schema = f"id {kinds['id']}, text string, n_lines long, n_removed long, n_chunks long" + "".join(
        f", `keep_{c}` {kinds[f'keep_{c}']}" for c in keep)
    done = full.mapInArrow(rebuild, schema)
    return done.select(F.col("id").alias(id_col), "text", "n_lines", "n_removed", "n_chunks",
                       *[F.col(f"keep_{c}").alias(c) for c in keep])


def digests(cleaned: DataFrame) -> DataFrame:
    """n_lines, n_removed, n_chunks and the digest of what is left, per row."""
    return cleaned.select(*[c for c in cleaned.columns if c != "text"],
                          F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))

