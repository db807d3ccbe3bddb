"""Operator 2: exact deduplication by Grace hashing.

Texts are equal when identical after every run of space, \\x09-\\x0D is
replaced by one space; null counts as empty.  Of equal texts the row with the
smallest id stays (rows without an id come last; of rows that tie, one stays).

Plan
----
1. Every input task runs its rows through a bounded open-addressing table.  A
   copy of a text that the task has seen becomes a light row (its task-local
   representative's key, no text), so a group of copies that holds a third of
   the corpus leaves a task as one text.
2. Representatives are dealt by the hash of their text: the shuffle's files
   are the first level of Grace partitions.  Within a task a partition that
   does not fit the table is split into spill files by further hash bits, and
   those again, until each bucket fits; a record only counts as a copy after
   its complete content compared equal.
3. The light rows are joined to their representative's group by a key that no
   more rows share than one task read.

Copies need no table space, so each pass over a bucket takes at least one new
text out of it and the recursion ends whatever the hashes are.
"""

from __future__ import annotations

import hashlib
import re
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save, utf8

TABLE_BYTES = 48 << 20
FANOUT = 16
_SPACES = re.compile(rb"[\x20\x09-\x0D]+")


def normalised(text: bytes) -> bytes:
    return _SPACES.sub(b" ", text)


class OpenTable:
    """Open addressing with linear probing over (hash, content) -> value.

    ``add`` returns the value stored for an equal content, or None after
    storing the new one; it raises ``MemoryError`` before exceeding the byte
    budget, unless the table is empty.
    """

    def __init__(self, budget: int = TABLE_BYTES):
        self.budget, self.used, self.count = budget, 0, 0
        self.slots: list = [None] * 1024

    def _slot(self, h: int, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = h & mask
        while (e := self.slots[at]) is not None and not (e[0] == h and e[1] == content):
            at = (at + 1) & mask
        return at

    def get(self, h: int, content: bytes):
        e = self.slots[self._slot(h, content)]
        return None if e is None else e[2]

    def add(self, h: int, content: bytes, value):
        at = self._slot(h, content)
        if self.slots[at] is not None:
            return self.slots[at][2]
        if self.count and self.used + len(content) + 200 > self.budget:
            raise MemoryError
        self.slots[at] = (h, content, value)
        self.used += len(content) + 200
        self.count += 1
        if 2 * self.count > len(self.slots):
            entries = [e for e in self.slots if e is not None]
            self.slots = [None] * (2 * len(self.slots))
            for e in entries:
                self.slots[self._slot(e[0], e[1])] = e
        return None


def _spilled(file) -> Iterator[tuple[int, int, bytes]]:
    file.seek(0)
    while head := file.read(20):
        key, h, size = struct.unpack("<qQi", head)
        yield key, h, file.read(size)


def resolve(records: Iterator[tuple[int, int, bytes]], folder: str, budget: int = TABLE_BYTES,
            level: int = 0) -> Iterator[tuple[int, int]]:
    """(key, leader key) of every (key, hash, content): equal contents share a leader."""
    table, files = OpenTable(budget), []
    for key, h, content in records:
        if not files:
            try:
                found = table.add(h, content, key)
                yield key, key if found is None else found
                continue
            except MemoryError:
                files = [tempfile.TemporaryFile(dir=folder) for _ in range(FANOUT)]
        elif (found := table.get(h, content)) is not None:
            yield key, found
            continue
        # fresh bits at every level: what shares a bucket here parts in the next
        at = int.from_bytes(hashlib.blake2b(struct.pack("<Qi", h, level), digest_size=2).digest(), "little")
        files[at % FANOUT].write(struct.pack("<qQi", key, h, len(content)) + content)
    del table
    for f in files:
        with f:
            yield from resolve(_spilled(f), folder, budget, level + 1)


_LIGHT = "key long, rep long, id {id}, sha binary, pkey long, content binary"


def _combine(budget: int, id_type: pa.DataType):
    def run(batches):
        base, n = TaskContext.get().partitionId() << 36, 0
        table = OpenTable(budget)
        schema = pa.schema([("key", pa.int64()), ("rep", pa.int64()), ("id", id_type), ("sha", pa.binary()),
                            ("pkey", pa.int64()), ("content", pa.binary())])
        for b in batches:
            out: list[list] = [[], [], [], [], [], []]
            for i, text in zip(b.column(0), b.column(1)):
                content = normalised(text.as_py())
                sha = hashlib.sha256(content).digest()
                h, = struct.unpack("<Q", sha[:8])
                key, n = base + n, n + 1
                try:
                    rep = table.add(h, content, key)
                except MemoryError:
                    table = OpenTable(budget)
                    rep = table.add(h, content, key)
                new = rep is None
                row = (key, key if new else rep, i.as_py(), sha if new else None,
                       h - (1 << 63) if new else key, content if new else None)
                for col, v in zip(out, row):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)
    return run


def _buckets(budget: int, id_type: pa.DataType):
    def run(batches):
        schema = pa.schema([("key", pa.int64()), ("rep", pa.int64()), ("id", id_type),
                            ("sha", pa.binary()), ("leader", pa.int64())])

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        heads, light = {}, []          # ids and digests of representatives; texts go to the table or to files

        def records():
            for b in batches:
                cols = [b.column(k).to_pylist() for k in range(6)]
                for key, rep, i, sha, pkey, content in zip(*cols):
                    if content is None:
                        light.append((key, rep, i, None, None))
                    else:
                        heads[key] = (i, sha)
                        yield key, pkey + (1 << 63), content

        with tempfile.TemporaryDirectory() as folder:
            out = []
            for key, leader in resolve(records(), folder, budget):
                out.append((key, key, *heads.pop(key), leader))
                if len(out) + len(light) >= 10_000:
                    yield made(out + light)
                    out.clear()
                    light.clear()
            if out or light:
                yield made(out + light)
    return run


def grace_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Row per input row: id, keep_id, group_size, kept, text_sha256, content-free.

    ``table_bytes`` bounds the texts held by a task at once.  Null texts count
    as empty; a row with a null id takes part, is kept only when no row of its
    group has an id, and its group's keep_id is then null.  Rows repeated with
    the same id: one of them is kept.  An empty table gives an empty result.
    """
    ids = docs.select(F.col(id_col).alias("id"))
    id_sql = ids.schema["id"].dataType.simpleString()
    id_arrow = docs.sparkSession.createDataFrame([], ids.schema).toArrow().schema.field("id").type
    rows = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("content"))
    parted = rows.mapInArrow(_combine(table_bytes, id_arrow), _LIGHT.format(id=id_sql))
    resolved = save(parted.repartition("pkey").mapInArrow(
        _buckets(table_bytes, id_arrow), f"key long, rep long, id {id_sql}, sha binary, leader long"), "grace")
    first = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("key").alias("key"))
    reps = resolved.groupBy("rep").agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("first"),
                                       F.max("leader").alias("leader"), F.max("sha").alias("sha"))
    groups = reps.groupBy("leader").agg(F.sum("n").alias("group_size"), F.min("first").alias("stay"))
    named = (reps.select("rep", "leader", F.lower(F.hex("sha")).alias("text_sha256"))
             .join(groups, "leader").drop("leader"))
    return (resolved.select("key", "rep", "id").join(named, "rep")
            .select(F.col("id").alias(id_col), F.col("stay.id").alias("keep_id"), "group_size",
                    (F.col("key") == F.col("stay.key")).alias("kept"), "text_sha256"))
