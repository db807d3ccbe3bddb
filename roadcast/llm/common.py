"""Helpers shared by the operators of this package.

* ``save`` cuts lineage by writing a table into the session's shared folder.
* ``bounded_filter`` builds a Bloom filter of fixed size, the only kind of
  corpus-derived data that is shipped to every task.  When it fills up it lets
  more rows through; an exact join follows wherever it is used.
* ``row_key`` identifies a row by what it holds, so that a second scan of the
  same table finds it again whatever the split layout is.
* ``word_spans`` / ``hash_spans`` hash all words (or lines) of a text at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def save(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write once into the shared folder and read back (ends the lineage there).

    The write's shuffle files go as soon as it has ended: nothing reads them again.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    old = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        w = df.write
        (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if old is None else spark.conf.set(_CLEANUP, old)
    return spark.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under new names (``new="old"``), found by exact spelling:
    other columns, also such as differ in case only, cannot clash with them."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{df.columns.index(old)}").alias(new) for new, old in columns.items()])


def utf8(c: str | Column) -> Column:
    """Text as UTF-8 bytes, null as empty."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("binary"), F.lit(b""))


def row_key(id_col: str, text_col: str) -> list[Column]:
    """128 bits of (id, text) as two longs.  Rows equal in both share a key, and
    every operator here gives such rows the same answer."""
    i, t = F.col(id_col), F.col(text_col)
    none = F.struct(i.isNull().cast("int"), t.isNull().cast("int"))
    return [F.xxhash64(F.lit(17), i, none, t).alias("k1"), F.xxhash64(t, F.lit(40503), none, i).alias("k2")]


# ------------------------------------------------------------- bounded filter
FILTER_BITS = 1 << 23


def filter_places(values: np.ndarray, bits: int = FILTER_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions of each 64-bit value."""
    h = mix64(values.astype(np.uint64, copy=False))
    return (h % np.uint64(bits)).astype(np.int64), ((h >> np.uint64(32)) % np.uint64(bits)).astype(np.int64)


def bounded_filter(df: DataFrame, col: str, bits: int = FILTER_BITS) -> np.ndarray:
    """Bloom filter (a byte array of ``bits / 8``) of the long column ``col``.

    At most ``bits / 64`` words come back to the driver, however many rows
    ``df`` has: each task folds its rows into words first.
    """
    def fold(batches):
        words = np.zeros(bits // 8, dtype=np.uint8)
        for b in batches:
            for place in filter_places(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits):
                np.bitwise_or.at(words, place >> 3, (1 << (place & 7)).astype(np.uint8))
        longs = words.view(np.int64)
        at = np.flatnonzero(longs)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(longs[at])], ["word", "bits"])

    words = (df.select(F.col(col).cast("long")).where(F.col(col).isNotNull())
             .mapInArrow(fold, "word long, bits long")
             .groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas())
    out = np.zeros(bits // 64, dtype=np.int64)
    out[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return out.view(np.uint8)


def in_filter(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    a, b = filter_places(values, bitmap.size * 8)
    return ((bitmap[a >> 3] >> (a & 7).astype(np.uint8)) & (bitmap[b >> 3] >> (b & 7).astype(np.uint8)) & 1).astype(bool)


def keep_probable(df: DataFrame, long_col: str, bitmap: np.ndarray) -> DataFrame:
    """Rows whose ``long_col`` may be in the filter; schema unchanged."""
    shared = df.sparkSession.sparkContext.broadcast(bitmap)
    at = df.columns.index(long_col)

    def pick(batches):
        for b in batches:
            keep = in_filter(shared.value, b.column(at).to_numpy(zero_copy_only=False).view(np.uint64))
            yield b.filter(pa.array(keep))
    return df.mapInArrow(pick, df.schema)


# ------------------------------------------------------------- hashing
def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


_BYTE = seeds(256, 11)
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64, at least ``n`` of them (kept per worker)."""
    have = _POWERS.get(base)
    if have is None or have.size < n:
        with np.errstate(over="ignore"):
            m = max(1 << 16, 1 << (n - 1).bit_length() if n > 1 else 1)
            have = np.full(m, base, dtype=np.uint64)
            have[0] = 1
            have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have


def running_hash(data: np.ndarray) -> np.ndarray:
    """S with S[i] = sum of value(byte j) * P^j over j < i; gives any span's hash."""
    out = np.zeros(data.size + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[data] * powers(_P, data.size)[:data.size], out=out[1:])
    return out


def hash_spans(run: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span [start, end), the same wherever it stands."""
    with np.errstate(over="ignore"):
        h = (run[end] - run[start]) * powers(_P_INV, run.size)[start]
        return mix64(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of bytes other than space and \\x09-\\x0D."""
    word = np.zeros(data.size + 2, dtype=np.int8)
    word[1:-1] = ~_SPACE[data]
    edge = np.diff(word)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]
