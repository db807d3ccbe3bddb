"""Operator 10: removal of repeated substrings with a run-length index.

Every byte covered by a string of ``length`` bytes that also starts earlier
(smaller id, or same document and earlier start) is removed.

1. *Anchors.*  Of the ``length - ANCHOR + 1`` anchor-sized strings in a window
   of ``length`` bytes, the one with the smallest hash is its anchor (leftmost
   of equals): equal windows have equal anchors at the same place.  An anchor
   with all bytes that share a window with it is a *context*.
2. Contexts are dealt by anchor.  Equal contexts: all but the earliest are
   repeats throughout (within a map task this is settled before the shuffle,
   so a passage that a third of the corpus holds leaves a task once).  An
   anchor with one context is unique.  What is left are anchors with different
   contexts: the edges of repeated passages, one context of each kind.
3. Their bytes are indexed, a bounded block of whole anchors at a time: the
   Burrows-Wheeler transform of the contexts is kept as runs, cut where
   neighbouring suffixes share less than ``length`` bytes, and each run's end
   is sampled with the earliest start among the suffixes that share its window.
   All contexts of the block are streamed back through the index by LF steps
   from a sampled entry: every step gives the row of one window, its run, and
   whether the window's match starts earlier.  Matches become byte ranges.
4. An anchor with more contexts than a block is cut into salted parts.  After
   the index has settled repeats inside each part, the windows that are still
   first in their part meet by a 128-bit digest, pre-aggregated.

Distinct contexts are what is indexed, so the cost follows what is different
in a repetitive corpus, not its size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_spans, mix64, running_hash, save, utf8

LENGTH = 100
ANCHOR = 32
FLUSH = 1_000_000
BLOCK = 16_384
PIECE = 1 << 20
LAST = (1 << 63) - 1


# ------------------------------------------------------------- anchors
def anchors(data: np.ndarray, length: int = LENGTH, size: int = ANCHOR):
    """(position, anchor hash, context hash, bytes left of it, bytes from it on)."""
    n, span = data.size, length - size + 1
    if n < length:
        return None
    pos, val = [], []
    # pieces overlap by a window, so every window is whole in one of them
    for at in range(0, n - length + 1, PIECE):
        part = data[at:at + PIECE + length - 1]
        run = running_hash(part)
        i = np.arange(part.size - size + 1)
        h = hash_spans(run, i, i + size)
        low = (h & np.uint64(0xFFFFFFFFFF000000)) | i.astype(np.uint64)    # ties: the leftmost
        w = 1
        while 2 * w <= span:
            low = np.minimum(low[:-w], low[w:])
            w *= 2
        if span > w:
            low = np.minimum(low[:low.size - (span - w)], low[span - w:])
        p = (low & np.uint64(0xFFFFFF)).astype(np.int64)
        p = p[np.concatenate([[True], p[1:] != p[:-1]])]
        pos.append(p + at)
        val.append(h[p])
    pos, val = np.concatenate(pos), np.concatenate(val)
    if n - length + 1 > PIECE:
        pos, once = np.unique(pos, return_index=True)
        val = val[once]
    left = np.minimum(pos, length - size)
    right = np.minimum(n - pos, length)
    run = running_hash(data)
    with np.errstate(over="ignore"):
        ctx = mix64(hash_spans(run, pos - left, pos + right) + left.astype(np.uint64))
    return pos, val.view(np.int64), ctx.view(np.int64), left, right


def _pack(pos, left, right, mark):
    return pos << 15 | left << 8 | right << 1 | mark


def _unpack(x):
    return x >> 15, x >> 8 & 127, x >> 1 & 127, x & 1


def _groups(*cols) -> np.ndarray:
    """True where a row starts a new group of equal columns (rows are sorted)."""
    out = np.zeros(cols[0].size, dtype=bool)
    if out.size:
        out[0] = True
        for c in cols:
            out[1:] |= c[1:] != c[:-1]
    return out


def _first_of(starts: np.ndarray) -> np.ndarray:
    """Index of the first row of each row's group."""
    return np.flatnonzero(starts)[np.cumsum(starts) - 1]


def merged(s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of byte ranges, maximal runs in order."""
    if not s.size:
        return s, e
    o = np.argsort(s, kind="stable")
    s, e = s[o], np.maximum.accumulate(e[o])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    return s[new], e[np.concatenate([np.flatnonzero(new)[1:] - 1, [s.size - 1]])]


def _settle(anchor, ctx, ids, key, packed):
    """Sort; equal contexts of an anchor: which rows are strictly later than the first."""
    pos = packed >> 15
    o = np.lexsort((key, pos, ids, ctx, anchor))
    anchor, ctx, ids, key, packed = anchor[o], ctx[o], ids[o], key[o], packed[o]
    same = _groups(anchor, ctx)
    first = _first_of(same)
    later = (ids != ids[first]) | (packed >> 15 != packed[first] >> 15)
    again = ~_groups(anchor, ctx, ids, key, packed)             # the same place once more
    return anchor, ctx, ids, key, packed, later, again


def _map_side(batches):
    held: list[list] = [[], [], [], [], []]
    size = 0

    def flush():
        anchor, ctx, ids, keys, packed, later, again = _settle(*(np.concatenate(c) for c in held))
        keep = ~later & ~again
        out = [anchor[keep], ctx[keep], ids[keep], keys[keep], packed[keep]]
        # repeats inside this task: byte ranges, joined up per document
        pos, left, right, _ = _unpack(packed[later & ~again])
        own, key = ids[later & ~again], keys[later & ~again]
        s, e = pos - left, pos + right
        o = np.lexsort((s, key, own))
        own, key, s, e = own[o], key[o], s[o], e[o]
        at = np.flatnonzero(_groups(own, key))
        ranges = [[], [], [], []]
        for a, b in zip(at, [*at[1:], own.size]):
            ms, me = merged(s[a:b], e[a:b])
            for col, v in zip(ranges, (np.full(ms.size, own[a]), np.full(ms.size, key[a]), ms, me)):
                col.append(v)
        if at.size:
            i, k, ms, me = (np.concatenate(c) for c in ranges)
            out = [np.concatenate([out[0], mix64(i.astype(np.uint64) + ms.astype(np.uint64)).view(np.int64)]),
                   np.concatenate([out[1], me]), np.concatenate([out[2], i]),
                   np.concatenate([out[3], k]), np.concatenate([out[4], _pack(ms, 0, 0, 1)])]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["anchor", "ctx", "id", "key", "packed"])

    for b in batches:
        for i, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            got = anchors(np.frombuffer(text.as_py(), dtype=np.uint8))
            if got is None:
                continue
            pos, val, ctx, left, right = got
            for col, v in zip(held, (val, ctx, np.full(pos.size, i, dtype=np.int64), np.full(pos.size, key, dtype=np.int64),
                                    _pack(pos, left, right, 0))):
                col.append(v)
            size += pos.size
            if size >= FLUSH:
                yield flush()
                held, size = [[], [], [], [], []], 0
    if size:
        yield flush()


_RANGES = "id long, key long, s int, e int, anchor long, n int, pos int"


def _by_anchor(batches):
    """All rows of some anchors: ranges of whole repeats, and the contexts to be indexed (pos >= 0)."""
    cols: list[list] = [[], [], [], [], []]
    for b in batches:
        for col, c in zip(cols, b.columns):
            col.append(c.to_numpy(zero_copy_only=False))
    if not cols[0]:
        return
    anchor, ctx, ids, key, packed = (np.concatenate(c) for c in cols)
    del cols
    mark = (packed & 1).astype(bool)
    yield _ranges(ids[mark], key[mark], packed[mark] >> 15, ctx[mark])
    anchor, ctx, ids, key, packed, later, again = _settle(*(c[~mark] for c in (anchor, ctx, ids, key, packed)))
    pos, left, right, _ = _unpack(packed)
    hit = later & ~again
    yield _ranges(ids[hit], key[hit], (pos - left)[hit], (pos + right)[hit])
    rep = ~later & ~again
    anchor, ctx, ids, key, pos, left, right = (c[rep] for c in (anchor, ctx, ids, key, pos, left, right))
    if not anchor.size:
        return
    # kinds of context per anchor
    of = np.cumsum(_groups(anchor)) - 1
    kinds = np.bincount(of, weights=_groups(anchor, ctx)).astype(np.int64)[of]
    ask = kinds > 1
    yield _ranges(ids[ask], key[ask], (pos - left)[ask], (pos + right)[ask], anchor[ask], kinds[ask], pos[ask])


def _ranges(ids, key, s, e, anchor=None, n=None, pos=None):
    none = np.full(ids.size, -1)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids.astype(np.int64)), pa.array(key.astype(np.int64)), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32)),
         pa.array((none if anchor is None else anchor).astype(np.int64)), pa.array((none if n is None else n).astype(np.int32)),
         pa.array((none if pos is None else pos).astype(np.int32))], ["id", "key", "s", "e", "anchor", "n", "pos"])


# ------------------------------------------------------------- run-length index
def sevens(text: np.ndarray) -> np.ndarray:
    """The seven symbols from each place on as one number (9 bits each, 0 past the row)."""
    n, wide = text.shape
    t = np.concatenate([text.astype(np.int64), np.zeros((n, 6), dtype=np.int64)], axis=1)
    out = t[:, :wide].copy()
    for k in range(1, 7):
        out <<= 9
        out |= t[:, k:k + wide]
    return out.ravel()


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Places (row * width + offset) of all suffixes of the rows of ``text``
    (symbols 1..256, 0: past the end) in order, equal suffixes by row.

    Prefix doubling; a pass sorts only suffixes that are not told apart yet.  A
    rank is the slot at which a suffix's group begins, so it holds when others
    are sorted; suffixes that end together without a difference are equal.
    """
    order = np.flatnonzero(text)
    rest = (np.count_nonzero(text, axis=1)[:, None] - np.arange(text.shape[1])).astype(np.int32).ravel()
    rank = np.zeros(text.size + 1, dtype=np.int32)
    slots, at, key, equal, depth = np.arange(order.size), order, sevens(text)[order], [], 7
    while slots.size:
        by = np.argsort(key)
        key, at = key[by], at[by]
        order[slots] = at
        heads = np.flatnonzero(_groups(key))
        many = np.diff(heads, append=key.size)
        now = np.repeat(slots[heads] + 1, many)
        rank[at] = now
        left = rest[at]
        open_, over = np.repeat(many > 1, many), left < depth
        equal.append(slots[open_ & over])
        go = open_ & ~over
        slots, at = slots[go], at[go]
        after = rank[at + depth]
        after[left[go] == depth] = 0                        # past the end
        key = now[go] << 32 | after
        depth *= 2
    slots = np.sort(np.concatenate(equal)) if equal else slots
    at = order[slots]
    order[slots] = at[np.argsort(rank[at].astype(np.int64) << 32 | at)]
    return order


class RunIndex:
    """r-index of short texts for windows of one length.

    Kept: the runs of the transform (symbol, start, and a bit per row with counts
    a word that tell a row's run), the rows at which a symbol's runs begin in the
    first column, one sample per run end (the earliest place of the run's
    window) and one entry row per text.
    """

    def __init__(self, text: np.ndarray, size: np.ndarray, place: np.ndarray, length: int = LENGTH):
        """``text``: rows of symbols 1..256, 0 past ``size``; ``place``: order of
        each text's first symbol among all places (start offsets add to it)."""
        n, wide = text.shape
        row, off = np.divmod(suffix_order(text), wide)
        # one terminator per text comes first, in the order of the texts
        row, off = np.concatenate([np.arange(n), row]), np.concatenate([size, off])
        before = np.where(off > 0, text[row, off - 1], 0)
        # windows: neighbours that share at least ``length`` symbols
        whole = off + length <= size[row]
        share = np.zeros(row.size, dtype=bool)
        a = np.flatnonzero(whole[1:] & whole[:-1])
        share[a + 1] = self._equal(text, row, off, a, a + 1, length)
        cut = ~share
        cut[1:] |= before[1:] != before[:-1]
        self.start = np.flatnonzero(cut)
        bits = np.zeros(-(-row.size // 64) * 64, dtype=np.uint8)
        bits[self.start] = 1
        self.begins = np.packbits(bits, bitorder="little").view("<u8")
        self.ahead = np.cumsum(np.append(0, np.bitwise_count(self.begins)[:-1].astype(np.int64)))
        self.symbol = before[self.start]
        size_of = np.diff(np.append(self.start, row.size))
        by = np.argsort(self.symbol, kind="stable")
        self.first = np.empty(self.start.size, dtype=np.int64)   # LF of each run's first row
        self.first[by] = np.cumsum(np.append(0, size_of[by][:-1]))
        # samples: earliest place of the window group that the run lies in
        group = np.cumsum(~share)[self.start] - 1
        heads = np.flatnonzero(~share)
        self.sample = np.minimum.reduceat(place[row] + off, heads)[group]
        # entry: the row of each text's last whole window
        entry = size - length
        self.entry = np.empty(n, dtype=np.int64)
        at = np.flatnonzero(off == entry[row])
        self.entry[row[at]] = at

    @staticmethod
    def _equal(text, row, off, i, j, length):
        """Whether the windows of rows i and j are the same: seven symbols at a time (``length`` >= 7)."""
        words, wide = sevens(text), text.shape[1]
        x, y = row[i] * wide + off[i], row[j] * wide + off[j]
        live = np.arange(i.size)
        for k in [length - 7, *range(0, length - 7, 7)]:
            live = live[words[x[live] + k] == words[y[live] + k]]
        out = np.zeros(i.size, dtype=bool)
        out[live] = True
        return out

    def _run_of(self, at: np.ndarray) -> np.ndarray:
        """The run each row lies in: runs begun before its word of 64 rows, and in it up to the row."""
        word = at >> 6
        upto = self.begins[word] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (63 - (at & 63)).astype(np.uint64))
        return self.ahead[word] + np.bitwise_count(upto) - 1

    def stream(self, size: np.ndarray, place: np.ndarray, length: int = LENGTH):
        """(text, offset) of every window with an earlier match, by LF steps."""
        live = np.flatnonzero(size >= length)
        at, off = self.entry[live], (size - length)[live]
        texts, offs = [], []
        while live.size:
            run = self._run_of(at)
            hit = self.sample[run] < place[live] + off
            texts.append(live[hit])
            offs.append(off[hit])
            go = off > 0
            at = (self.first[run] + at - self.start[run])[go]
            live, off = live[go], off[go] - 1
        return (np.concatenate(texts), np.concatenate(offs)) if texts else (np.zeros(0, int), np.zeros(0, int))


def _index_block(rows: list[tuple]):
    """Ranges repeated inside a block of contexts, and windows to be settled across parts."""
    rows.sort(key=lambda r: (r[0], r[2]))                   # by (id, start): the earlier is smaller
    ids = np.array([r[0] for r in rows])
    key = np.array([r[1] for r in rows])
    start = np.array([r[2] for r in rows])
    size = np.array([len(r[3]) for r in rows])
    wide = int(size.max())
    text = np.zeros((len(rows), wide), dtype=np.int16)
    data = np.frombuffer(b"".join(r[3] for r in rows), dtype=np.uint8)
    text[np.arange(wide) < size[:, None]] = data.astype(np.int16) + 1
    # places as one number: documents far apart, offsets inside
    doc = np.cumsum(_groups(ids)) - 1
    place = (doc.astype(np.int64) << 32) + start
    index = RunIndex(text, size, place)
    t, o = index.stream(size, place)
    order = np.lexsort((o, t))
    t, o = t[order], o[order]
    # consecutive windows make one range
    new = np.ones(t.size, dtype=bool)
    new[1:] = (t[1:] != t[:-1]) | (o[1:] != o[:-1] + 1)
    a = np.flatnonzero(new)
    z = np.append(a[1:], t.size) - 1
    marks = _ranges(ids[t[a]], key[t[a]], start[t[a]] + o[a], start[t[a]] + o[z] + LENGTH) if t.size else None
    open_ = []
    if any(r[4] for r in rows):
        repeated = set(zip(t.tolist(), o.tolist()))
        for k, r in enumerate(rows):
            if r[4]:
                for w in range(len(r[3]) - LENGTH + 1):
                    if (k, w) not in repeated:
                        d = xxhash.xxh3_128_digest(r[3][w:w + LENGTH])
                        open_.append((r[0], r[1], r[2] + w, d))
    return marks, open_


_WINDOWS = "id long, key long, s int, e int, digest binary"


def _index_contexts(block: int):
    def run(batches):
        def out(marks, open_):
            if marks is not None:
                yield pa.RecordBatch.from_arrays([*marks.columns[:4], pa.nulls(marks.num_rows, pa.binary())],
                                                 ["id", "key", "s", "e", "digest"])
            if open_:
                i, k, s, d = zip(*open_)
                s = np.array(s, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(k, pa.int64()), pa.array(s),
                                                  pa.array(s + LENGTH), pa.array(d, pa.binary())], ["id", "key", "s", "e", "digest"])
        rows, last = [], None
        for b in batches:
            for anchor, part, cut, i, key, s, text in zip(*(c.to_pylist() for c in b.columns)):
                if (anchor, part) != last and len(rows) >= block // 2 or len(rows) >= 2 * block:
                    yield from out(*_index_block(rows))
                    rows = []
                last = (anchor, part)
                rows.append((i, key, s, text, cut))
        if rows:
            yield from out(*_index_block(rows))
    return run


def _contexts(batches):
    """Cut the asked contexts out of their documents."""
    for b in batches:
        cols: list[list] = [[] for _ in range(7)]
        for i, key, text, asks in zip(*(c.to_pylist() for c in b.columns)):
            for a in asks:
                for col, v in zip(cols, (a["anchor"], a["part"], a["cut"], i, key, a["s"], text[a["s"]:a["e"]])):
                    col.append(v)
        kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         ["anchor", "part", "cut", "id", "key", "s", "text"])


def repeated_ranges(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(id, key, s, e): byte ranges of ``rows`` (id, key, text) covered by repeats."""
    first = save(rows.mapInArrow(_map_side, "anchor long, ctx long, id long, key long, packed long")
                 .repartition("anchor").mapInArrow(_by_anchor, _RANGES), "repeat-ranges")
    parts = F.ceil(F.col("n") / block).cast("int")
    asks = (first.where("pos >= 0")
            .withColumn("part", F.pmod(F.xxhash64("id", "key", "pos"), parts).cast("int"))
            .groupBy("id", "key").agg(F.collect_list(F.struct("anchor", "part", (parts > 1).alias("cut"), "s", "e")).alias("asks")))
    texts = (rows.join(asks, ["id", "key"]).select("id", "key", "text", "asks")
             .mapInArrow(_contexts, "anchor long, part int, cut boolean, id long, key long, s int, text binary"))
    found = save(texts.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
                 .mapInArrow(_index_contexts(block), _WINDOWS), "repeat-index")
    # windows of anchors that were cut into parts: the earliest of each stays
    cut = found.where(F.col("digest").isNotNull())
    low = cut.groupBy("digest").agg(F.min(F.struct("id", "s")).alias("low"))
    across = (cut.join(low, "digest").where((F.col("id") != F.col("low.id")) | (F.col("s") != F.col("low.s"))))
    return (first.where("pos < 0").select("id", "key", "s", "e")
            .unionByName(found.where(F.col("digest").isNull()).select("id", "key", "s", "e"))
            .unionByName(across.select("id", "key", "s", "e")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
                   block: int = BLOCK) -> DataFrame:
    """Row per input row: id, n_bytes, n_removed, n_spans, kept_sha256 (and, with
    ``with_text``, ``kept``: the remaining bytes, and ``spans``: the removed ranges).

    Texts are UTF-8 bytes, null counts as empty; matches never cross rows.
    Rows order by id, rows without one last.  Rows that repeat an id start at
    the same places: a string at the same offset of two such rows is in neither
    case earlier.  A row is told by its id and 64 bits of its text's hash.  An empty table gives an empty result.
    """
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id")
    text = utf8(text_col)
    rows = docs.select(F.col(id_col).alias("own"), order, F.xxhash64(text).alias("key"),
                       text.alias("text"))
    ranges = (repeated_ranges(rows.select("id", "key", "text"), block).groupBy("id", "key")
              .agg(F.collect_list(F.struct("s", "e")).alias("ranges")))
    kind = rows.schema["own"].dataType.simpleString()
    span = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))

    def run(batches):
        for b in batches:
            size, gone, runs, sha, kept, spans = [], [], [], [], [], []
            for text, r in zip(b.column(1), b.column(2)):
                data, r = text.as_py(), r.as_py()
                if r:
                    s, e = merged(np.array([x["s"] for x in r]), np.array([x["e"] for x in r]))
                else:
                    s = e = np.zeros(0, dtype=np.int64)
                rest = b"".join(data[x:y] for x, y in zip([0, *e.tolist()], [*s.tolist(), len(data)]))
                size.append(len(data))
                gone.append(len(data) - len(rest))
                runs.append(s.size)
                sha.append(hashlib.sha256(rest).hexdigest())
                if with_text:
                    kept.append(rest)
                    spans.append([{"s": x, "e": y} for x, y in zip(s.tolist(), e.tolist())])
            cols = [b.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string())]
            names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                cols += [pa.array(kept, pa.binary()), pa.array(spans, span)]
                names += ["kept", "spans"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return (rows.join(ranges, ["id", "key"], "left").select("own", "text", "ranges")
            .mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                        + (", kept binary, spans array<struct<s:int,e:int>>" if with_text else "")))
