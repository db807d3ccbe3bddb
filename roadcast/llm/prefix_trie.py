"""Prefix trie of conversations by a splitter skeleton.

Every distinct sequence of first turns is a node.  The trie is never held
anywhere as a whole:

1. Turns become 128-bit keys and lengths; no text is moved.  They are range
   partitioned by (conversation, turn) and cut into pieces of at most ``PIECE``
   turns, so a conversation of any length is many rows; a turn's place is the
   sum of the pieces before its own.
2. Conversations with equal turns are one *path* with a count; their ids are
   hashed in ascending order as a stream, never held.
3. A bounded sample of paths, weighted by size, gives *splitters*: paths that
   cut the sorted paths into shards of about equal size.  Only prefixes of a
   splitter, the *skeleton*, can lie in more than one shard.
4. The skeleton is broadcast.  Each shard, sorted, finishes all its other
   nodes in one streaming pass that holds the open path and the children whose
   parent is still open; for skeleton nodes it gives partial aggregates, which
   are reduced (sums and minima) to one row each and rolled up from the leaves.

Size bounds: at most ``SHARDS`` splitters of at most ``DEPTH`` turns, 24 bytes a
turn, go to the tasks, and as many rows come back; the sample has at most
``8 * SHARDS`` paths.  A path is sorted only as deep as it shares a boundary (a
multiple of ``DEPTH`` turns) with another, and to the next one: beyond, nodes
belong to it alone and are written straight from its pieces.  Paths longer than
that which share all of it are held whole, one at a time.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix64, pick, save

PIECE = 4096            # turns in a row
DEPTH = 256             # turns of a splitter, and between boundaries
SHARDS = 4096           # most shards, hence splitters
SHARD_TURNS = 100_000   # turns in a shard, as far as SHARDS allows
BLOCK = 100             # conversations that share the head of one
HEAD = 6                # heads are 0 to HEAD - 1 turns
NOBODY = hashlib.sha256(b"").hexdigest()
ITEMS = "array<struct<k1:bigint,k2:bigint,len:bigint>>"
NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string")
_PARTS = f"skeleton long, under long, {NODES}"


# ------------------------------------------------------------------ turns in order
def pieces(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv, start, items): runs of at most ``PIECE`` turns in order; ``start`` turns come before."""
    rows = pick(turns, conv=conv_col, turn=turn_col, role=role_col, text=text_col).where("conv IS NOT NULL")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = rows.select(F.col("conv").cast("long").alias("conv"), "turn", F.xxhash64(F.lit(1), role, text).alias("k1"),
                       F.xxhash64(text, F.lit(2), role).alias("k2"), F.char_length(text).cast("long").alias("len"))
    order = [F.col("conv").asc(), F.col("turn").asc_nulls_first(), F.col("k1").asc(), F.col("k2").asc()]

    def cut(batches) -> Iterator[pa.RecordBatch]:
        task, no = TaskContext.get().partitionId(), 0
        names = ["conv", "part", "no", "k1", "k2", "len"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 3]
        open_conv, held = None, []

        def row():
            nonlocal no
            no += 1
            return (open_conv, task, no, *(np.concatenate(x) for x in zip(*held)))

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        for b in batches:
            conv, *cols = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3, 4))
            marks = [0, *(np.flatnonzero(np.diff(conv)) + 1), conv.size] if conv.size else []
            out = []
            for s, e in zip(marks, marks[1:]):
                if held and open_conv != conv[s]:
                    out.append(row())
                    held = []
                open_conv = int(conv[s])
                while s < e:
                    take = min(e - s, PIECE - sum(x[0].size for x in held))
                    held.append([c[s:s + take].copy() for c in cols])
                    s += take
                    if sum(x[0].size for x in held) == PIECE:
                        out.append(row())
                        held = []
            if out:
                yield batch(out)
        if held:
            yield batch([row()])

    cutting = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
               .mapInArrow(cut, "conv long, part int, no long, k1 array<long>, k2 array<long>, len array<long>"))
    kept = save(cutting, "trie-pieces")
    before = Window.partitionBy("conv").orderBy("part", "no").rowsBetween(Window.unboundedPreceding, -1)
    return kept.select("conv", F.coalesce(F.sum(F.size("k1")).over(before), F.lit(0)).alias("start"),
                       F.arrays_zip("k1", "k2", "len").cast(ITEMS).alias("items"))


def with_heads(cut: DataFrame, block: int = BLOCK, head: int = HEAD) -> DataFrame:
    """Every conversation c with its first h = crc32(c) % head turns taken from
    conversation c - c % block: (conv, start, items), start counted anew."""
    base = F.col("conv") - F.col("conv") % block
    first = (cut.where((F.col("conv") % block == 0) & (F.col("start") < head - 1))
             .select(F.col("conv").alias("base"), F.struct("start", "items").alias("piece"))
             .groupBy("base").agg(F.slice(F.flatten(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["items"])),
                                          1, head - 1).alias("head")))      # head - 1 pieces at most
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % head).cast("int")
    rows = (cut.withColumn("base", base).withColumn("h", h).join(first, "base", "left")
            .withColumn("head", F.slice(F.coalesce("head", F.array().cast(ITEMS)), F.lit(1), F.col("h"))))
    drop = F.greatest(F.lit(0), F.col("h") - F.col("start")).cast("int")
    own = F.slice("items", drop + 1, F.greatest(F.size("items"), F.lit(0)))
    at_head = F.col("start") == 0
    return (rows.select("conv", F.when(at_head, F.lit(0)).otherwise(F.size("head") + F.greatest("start", "h") - F.col("h"))
                        .cast("long").alias("start"),
                        F.when(at_head, F.concat("head", own)).otherwise(own).alias("items"))
            .where((F.col("start") == 0) | (F.size("items") > 0)))


# ------------------------------------------------------------------ paths
def _blocks(cut: DataFrame) -> DataFrame:
    """(conv, block, n, x1, x2): an order-aware digest of each ``DEPTH`` turns, one row per piece and block."""
    def fold(batches):
        for b in batches:
            items = b.column(2)
            sizes = np.diff(items.offsets.to_numpy())
            flat = items.flatten()
            k1, k2 = (flat.field(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1))
            row = np.repeat(np.arange(sizes.size), sizes)
            within = np.arange(row.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            depth = within + b.column(1).to_numpy()[row]
            with np.errstate(over="ignore"):
                place = mix64(depth.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
                x1, x2 = mix64(k1 + mix64(k2 ^ place)), mix64(k2 + mix64(k1 + place) + place)
            block = depth // DEPTH
            at = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (np.diff(block) != 0)]) if row.size else np.empty(0, np.int64)
            none = np.flatnonzero(sizes == 0)
            n = np.diff(np.r_[at, row.size])
            xor = lambda x: np.bitwise_xor.reduceat(x, at) if at.size else np.empty(0, np.uint64)      # noqa: E731
            conv, zero = b.column(0).to_numpy(), np.zeros(none.size, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (
                np.r_[conv[row[at]], conv[none]], np.r_[block[at], zero], np.r_[n, zero],
                np.r_[xor(x1).view(np.int64), zero], np.r_[xor(x2).view(np.int64), zero])], ["conv", "block", "n", "x1", "x2"])

    return cut.mapInArrow(fold, "conv long, block long, n long, x1 long, x2 long")


def paths(blocks: DataFrame) -> DataFrame:
    """(path, weight, turns, ends): conversations of equal turns under their smallest
    id, how many they are, and the digest of all their ids in ascending order."""
    whole = blocks.groupBy("conv").agg(F.sum("n").alias("n"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))

    def fold(batches):
        key, first, count, sha = None, 0, 0, None

        def flushed(done):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                              ["path", "weight", "turns", "ends"])

        for b in batches:
            done = []
            conv, n, x1, x2 = (b.column(i).to_numpy() for i in range(4))
            marks = [0, *(np.flatnonzero(np.diff(n) | np.diff(x1) | np.diff(x2)) + 1), conv.size] if conv.size else []
            for s, e in zip(marks, marks[1:]):
                now = (int(n[s]), int(x1[s]), int(x2[s]))
                ids = ",".join(map(str, conv[s:e].tolist())).encode()
                if now == key:
                    sha.update(b"," + ids)
                    count += int(e - s)
                    continue
                if key is not None:
                    done.append((first, count, key[0], sha.hexdigest()))
                key, first, count, sha = now, int(conv[s]), int(e - s), hashlib.sha256(ids)
            if done:
                yield flushed(done)
        if key is not None:
            yield flushed([(first, count, key[0], sha.hexdigest())])

    return (whole.select("conv", "n", "x1", "x2").repartition("n", "x1", "x2").sortWithinPartitions("n", "x1", "x2", "conv")
            .mapInArrow(fold, "path long, weight long, turns long, ends string"))


def _cuts(blocks: DataFrame, found: DataFrame) -> DataFrame:
    """(path, cut) of paths of more than ``DEPTH`` turns: beyond ``cut`` no other path shares a node."""
    deep = blocks.join(found.where(F.col("turns") > DEPTH).select(F.col("path").alias("conv"), "turns"), "conv")
    per = (deep.groupBy("conv", "turns", "block").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2")))
    upto = Window.partitionBy("conv").orderBy("block")
    marks = per.select("conv", "turns", "block", F.bit_xor("x1").over(upto).alias("x1"), F.bit_xor("x2").over(upto).alias("x2"))
    marks = marks.where((F.col("block") + 1) * DEPTH <= F.col("turns"))
    shared = marks.groupBy("block", "x1", "x2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    last = (marks.join(shared, ["block", "x1", "x2"]).groupBy("conv").agg(F.max("block").alias("last")))
    return (marks.select("conv").distinct().join(last, "conv", "left")
            .select(F.col("conv").alias("path"), ((F.coalesce("last", F.lit(-1)) + 2) * DEPTH).alias("cut")))


# ------------------------------------------------------------------ skeleton
class Skeleton:
    """Trie of the splitter paths; node ids grow from parent to child, the root is 0."""

    def __init__(self, splitters: list[list[tuple[int, int, int]]]):
        self.paths = [tuple(p) for p in splitters]
        self.children: list[dict[tuple, int]] = [{}]
        self.parent, self.depth, self.len = [-1], [0], [0]
        for p in self.paths:
            at = 0
            for item in p:
                nxt = self.children[at].get(item)
                if nxt is None:
                    nxt = self.children[at][item] = len(self.parent)
                    self.children.append({})
                    self.parent.append(at)
                    self.depth.append(self.depth[at] + 1)
                    self.len.append(item[2])
                at = nxt

    def shard(self, path) -> int:
        return bisect_right(self.paths, path)

    def roll_up(self, parts: dict[int, tuple]) -> list[tuple]:
        """Finished rows (id, conv, depth, parent's conv, ...) from reduced partials
        (conv, n_convs, n_children, n_leaves, saved, ends) by node id."""
        n = len(self.parent)
        conv, members, kids, leaves, saved, ends = ([None] * n, [0] * n, [0] * n, [0] * n, [0] * n, [NOBODY] * n)
        for i, p in parts.items():
            conv[i], members[i], kids[i], leaves[i], saved[i], ends[i] = p
        for i in range(n - 1, -1, -1):
            kids[i] += len(self.children[i])
            leaves[i] = leaves[i] if kids[i] else 1
            saved[i] += (members[i] - 1) * self.len[i]
            up = self.parent[i]
            if up >= 0:
                conv[up] = conv[i] if conv[up] is None else min(conv[up], conv[i])
                members[up] += members[i]
                leaves[up] += leaves[i]
                saved[up] += saved[i]
        return [(i, conv[i], self.depth[i], conv[self.parent[i]] if i else None, members[i], kids[i], leaves[i], saved[i],
                 ends[i]) for i in range(n)] if parts else []


def _items(column: pa.Array) -> Iterator[list[tuple[int, int, int]]]:
    """The turns of each row as (k1, k2, len) tuples."""
    flat, ends = column.flatten(), column.offsets.to_numpy() - column.offsets[0].as_py()
    cols = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(3)]
    for s, e in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield list(zip(*(c[s:e].tolist() for c in cols)))


def _splitters(trunks: DataFrame) -> tuple[Skeleton, int]:
    spark = trunks.sparkSession
    turns = trunks.agg(F.sum(F.size("items") + 1)).first()[0] or 0
    shards = min(SHARDS, max(spark.sparkContext.defaultParallelism, -(-turns // SHARD_TURNS)))
    # a path's chance to come first grows with its size
    chance = (F.pmod(F.xxhash64("path", F.lit(5)), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    drawn = (trunks.select(F.slice("items", 1, DEPTH).alias("items"), "path", (-F.ln(chance) / (F.size("items") + 1)).alias("draw"))
             .orderBy("draw", "path").limit(8 * shards).select("items").toArrow())
    paths_ = sorted(p for chunk in drawn.column(0).chunks for p in _items(chunk))
    picked = [paths_[i * len(paths_) // shards] for i in range(1, shards)] if paths_ else []
    return Skeleton([list(p) for p in dict.fromkeys(map(tuple, picked))]), shards


class _Node:
    __slots__ = ("conv", "members", "kids", "leaves", "saved", "ends", "len", "skeleton", "waiting")

    def __init__(self, length: int, skeleton: int):
        self.conv, self.members, self.kids, self.leaves, self.saved, self.ends = None, 0, 0, 0, 0, NOBODY
        self.len, self.skeleton, self.waiting = length, skeleton, []


def _finish(skeleton: Skeleton, rows: Iterator[tuple]) -> Iterator[tuple]:
    """Node rows and skeleton partials of sorted paths (items, path, weight, ends or None for a
    path that goes on as a tail, saved tokens of the tail)."""
    stack, here = [_Node(0, 0)], []

    def close():
        v = stack.pop()
        if v.skeleton >= 0:                     # the root too: partials are reduced with those of other shards
            if v.members or v.kids:
                yield (v.skeleton, None, v.conv, len(stack), None, v.members, v.kids, v.leaves, v.saved, v.ends)
            return
        if not v.kids:
            v.leaves = 1
        v.saved += (v.members - 1) * v.len
        for row in v.waiting:
            yield (None, None, *row[:2], v.conv, *row[2:])
        up = stack[-1]
        up.conv = v.conv if up.conv is None else min(up.conv, v.conv)
        up.members += v.members
        up.kids += 1
        up.leaves += v.leaves
        up.saved += v.saved
        row = (v.conv, len(stack), v.members, v.kids, v.leaves, v.saved, v.ends)
        if up.skeleton >= 0:
            yield (None, up.skeleton, *row[:2], None, *row[2:])
        else:
            up.waiting.append(row)

    for items, path, weight, ends, tail in rows:
        same = 0
        for a, b in zip(here, items):
            if a != b:
                break
            same += 1
        while len(stack) > same + 1:
            yield from close()
        for item in items[same:]:
            up = stack[-1].skeleton
            stack.append(_Node(item[2], skeleton.children[up].get(item, -1) if up >= 0 else -1))
        v, here = stack[-1], items
        v.conv = path if v.conv is None else min(v.conv, path)
        v.members += weight
        if ends is None:
            v.kids += 1
            v.leaves += 1
            v.saved += tail
        else:
            v.ends = ends
    while stack:
        yield from close()


def _shard_rows(trunks: DataFrame, skeleton: Skeleton, shards: int) -> DataFrame:
    shared = trunks.sparkSession.sparkContext.broadcast(skeleton)
    at = trunks.columns.index("items")
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in trunks.schema)}, shard int"

    def deal(batches):
        for b in batches:
            to = [shared.value.shard(tuple(p[:DEPTH])) for p in _items(b.column(at))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(to, pa.int32())], [*b.schema.names, "shard"])

    def finish(batches):
        names = [x.split()[0] for x in _PARTS.split(", ")]
        kinds = [pa.int64()] * (len(names) - 1) + [pa.string()]

        def rows():
            for b in batches:
                path, weight, ends, tail = (b.column(i).to_pylist() for i in (0, 1, 2, 3))
                yield from zip(_items(b.column(4)), path, weight, ends, tail)

        held = []
        for row in _finish(shared.value, rows()):
            held.append(row)
            if len(held) == 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names)

    dealt = trunks.mapInArrow(deal, schema).repartitionByRange(shards, "shard").sortWithinPartitions("shard", "items")
    return dealt.select("path", "weight", "ends", "tail", "items").mapInArrow(finish, _PARTS)


def _tail_nodes(tails: DataFrame) -> DataFrame:
    """Nodes of one path alone: (path, weight, ends, last, start, items, after) with the code points after the piece."""
    def spread(batches):
        names = [x.split()[0] for x in NODES.split(", ")]
        for b in batches:
            cols = [b.column(i).to_pylist() for i in (0, 1, 2, 3, 4, 6)]
            for items, path, weight, ends, last, start, after in zip(_items(b.column(5)), *cols):
                left = after + np.cumsum([x[2] for x in items][::-1])[::-1]
                depth = start + 1 + np.arange(len(items))
                same = lambda x: np.full(len(items), x, dtype=np.int64)                 # noqa: E731
                over = depth == last
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (same(path), depth, same(path), same(weight), 1 - over.astype(np.int64),
                                                  same(1), (weight - 1) * left, [ends if x else NOBODY for x in over])], names)

    return tails.mapInArrow(spread, NODES)


def trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
         text_col: str = "text", block: int = BLOCK, head: int = HEAD) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations (``with_heads``).

    Result: conv_id (smallest member), depth, parent_conv_id (null at the root),
    n_convs (members), n_children, n_leaves, saved_tokens (over the subtree,
    (n_convs - 1) times the code points of the node's last text), ends_sha256
    (ids of the conversations that end here, ascending, comma-joined).

    Null role or text: empty.  Null turns come first; turns of one place are
    ordered by their hash, so repeated rows are turns of their own and reruns
    agree.  Rows without conv_id are no conversation.  % is that of SQL, towards
    zero for negative ids.  No conversations: no rows, not even a root.
    """
    cut = save(with_heads(pieces(conversations, conv_col, turn_col, role_col, text_col), block, head), "trie-rebuilt")
    spark = cut.sparkSession
    blocks = save(_blocks(cut), "trie-blocks")
    found = save(paths(blocks), "trie-paths")
    # only pieces of paths go on: one conversation stands for all its copies
    ends = found.join(_cuts(blocks, found), "path", "left").withColumn("cut", F.coalesce("cut", "turns"))
    own = save(cut.withColumnRenamed("conv", "path").join(ends, "path"), "trie-own")
    shallow = own.where(F.col("start") < F.greatest("cut", F.lit(1)))
    part = F.struct("start", F.slice("items", F.lit(1), F.greatest(F.col("cut") - F.col("start"), F.lit(0)).cast("int")).alias("items"))
    goes_on = F.col("turns") > F.col("cut")
    deep = own.where(goes_on & (F.col("start") + F.size("items") > F.col("cut")))
    skip = F.greatest(F.col("cut") - F.col("start"), F.lit(0)).cast("int")
    deep = deep.select("path", "weight", "ends", F.col("turns").alias("last"), (F.col("start") + skip).alias("start"),
                       F.slice("items", skip + 1, F.size("items")).alias("items"))
    chars = F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + x["len"])
    behind = Window.partitionBy("path").orderBy("start").rowsBetween(1, Window.unboundedFollowing)
    deep = deep.withColumn("after", F.coalesce(F.sum(chars).over(behind), F.lit(0)))
    tail = deep.groupBy("path").agg(F.sum((F.col("weight") - 1) * chars).alias("tail"))
    trunks = (shallow.groupBy("path").agg(F.first("weight").alias("weight"), F.first(F.when(~goes_on, F.col("ends"))).alias("ends"),
                                          F.array_sort(F.collect_list(part)).alias("parts"))
              .join(tail, "path", "left")
              .select("path", "weight", "ends", F.coalesce("tail", F.lit(0)).alias("tail"),
                      F.flatten(F.transform("parts", lambda p: p["items"])).alias("items")))
    trunks = save(trunks, "trie-trunks")
    skeleton, shards = _splitters(trunks)
    parts = save(_shard_rows(trunks, skeleton, shards), "trie-parts")
    reduced = (parts.where("skeleton IS NOT NULL").groupBy("skeleton")
               .agg(F.min("conv_id"), F.sum("n_convs"), F.sum("n_children"), F.sum("n_leaves"), F.sum("saved_tokens"),
                    F.coalesce(F.max(F.when(F.col("ends_sha256") != NOBODY, F.col("ends_sha256"))), F.lit(NOBODY))).collect())
    top = spark.createDataFrame(skeleton.roll_up({r[0]: tuple(r)[1:] for r in reduced}), f"skeleton long, {NODES}")
    names = [x.split()[0] for x in NODES.split(", ")]
    over = F.broadcast(top.select(F.col("skeleton").alias("under"), F.col("conv_id").alias("up")))      # the skeleton's size
    nodes = (parts.where("skeleton IS NULL").join(over, "under", "left")
             .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up")).select(*names))
    return nodes.unionByName(top.select(*names)).unionByName(_tail_nodes(deep))
