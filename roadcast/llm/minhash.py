r"""Operator 5: MinHash near-duplicates with sequential Bayesian verification.

Words are the runs ``[^\x20\x09-\x0D]+`` of the text with A-Z lower-cased; a
document is the set of its shingles (``width`` consecutive words; fewer words:
the whole sequence).  Two documents are linked when 100 |A n B| >= percent |A u B|.

1. One pass makes a signature of ``BANDS * ROWS`` minima per document.
   Documents with the same word sequence become one class.
2. Classes that share a band are candidates.  A bucket first offers each
   member with one leader (smallest under an order that changes per round), so
   a group of near copies costs one pair per member and band, not all pairs.
3. Signatures of a pair are compared in batches; after each, the posterior of
   the similarity (uniform prior, binomial matches) is read off: when the
   chance that it reaches the threshold is below ``MISS``, the pair is dropped.
   Of a member's surviving leaders the one with most equal minima is verified
   on the complete shingle sets of both texts: one link per member and round.
4. Links form components.  Buckets whose members are in several components
   then compare every pair that crosses components (members outside the largest
   against all), once each and block by block: what the leaders did not
   connect is not lost.  Comparisons, not rows, still grow with the square of
   a family whose members share bands and stay just below the threshold.

Chance of missing a pair at 0.8 in step 2: (1 - 0.8^5)^30 = 7e-6; in step 3,
MISS per batch.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (bounded_filter, hash_spans, keep_probable, lower_ascii, mix64, row_key, running_hash, save, seeds,
                     utf8, word_spans)
from .components import components

BANDS, ROWS = 30, 5
BATCH = 30
MISS = 1e-7
LEADER_ROUNDS = 4
BLOCK = 512
HELD = 400_000         # shingles a task keeps as sets
_XOR, _MUL = seeds(BANDS * ROWS, 7), seeds(BANDS * ROWS, 77) | np.uint64(1)
_STEP = seeds(64, 5) | np.uint64(1)


# ------------------------------------------------------------- one document
def words(text: bytes) -> list[bytes]:
    data = lower_ascii(np.frombuffer(text, dtype=np.uint8))
    start, end = word_spans(data)
    low = data.tobytes()
    return [low[s:e] for s, e in zip(start.tolist(), end.tolist())]


def shingles(text: bytes, width: int) -> set[tuple[bytes, ...]]:
    """The document's set, as it is compared in the end."""
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return set(zip(*(w[k:] for k in range(width))))


def shingle_hashes(text: bytes, width: int) -> tuple[np.ndarray, bytes]:
    """(distinct shingle hashes, digest of the word sequence)."""
    data = lower_ascii(np.frombuffer(text, dtype=np.uint8))
    start, end = word_spans(data)
    if not start.size:
        return np.zeros(0, dtype=np.uint64), b""
    h = hash_spans(running_hash(data), start, end)
    # the words joined by one space each: spaces of the input left out
    keep = np.zeros(data.size + 1, dtype=bool)
    keep[end] = True
    inside = np.zeros(data.size + 1, dtype=np.int8)
    np.add.at(inside, start, 1)
    np.add.at(inside, end, -1)
    keep |= np.cumsum(inside).astype(bool)
    joined = np.append(data, np.uint8(32))
    joined[end] = 32
    digest = hashlib.blake2b(joined[keep].tobytes(), digest_size=16).digest()
    n = max(1, h.size - width + 1)
    with np.errstate(over="ignore"):
        s = np.zeros(n, dtype=np.uint64)
        for k in range(min(width, h.size)):
            s += h[k:k + n] * _STEP[k]
        s = mix64(s + np.uint64(min(width, h.size)))
    return np.unique(s), digest


def signature(s: np.ndarray) -> np.ndarray:
    """Minima of BANDS * ROWS hash functions, 16 bits each (two different minima
    look equal once in 65,536 times, far below what the posterior resolves).
    The minima of a long text are all small, so each is mixed before it is cut."""
    low = np.full(_MUL.size, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, s.size, 1024):
            part = s[at:at + 1024, None] ^ _XOR
            part *= _MUL
            np.minimum(low, part.min(axis=0), out=low)
    return (mix64(low) >> np.uint64(48)).astype(np.uint16)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band (the band's number is part of it)."""
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    with np.errstate(over="ignore"):
        h = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(ROWS):
            h = mix64(h ^ rows[:, k] * _STEP[k])
    return h.view(np.int64)


# ------------------------------------------------------------- verification
def chance_at_least(t: float, matches: int, n: int) -> float:
    """P(similarity >= t | ``matches`` of ``n`` minima equal), uniform prior:
    the upper tail of Beta(m + 1, n - m + 1), which is a binomial sum."""
    return sum(math.exp(math.lgamma(n + 2) - math.lgamma(k + 1) - math.lgamma(n + 2 - k)
                        + k * math.log(t) + (n + 1 - k) * math.log1p(-t)) for k in range(matches + 1))


@functools.cache
def least_matches(percent: int, miss: float = MISS) -> tuple[int, ...]:
    """After each batch: the fewest equal minima with which a pair goes on."""
    return tuple(next((m for m in range(n + 1) if chance_at_least(percent / 100, m, n) >= miss), n + 1)
                 for n in range(BATCH, BANDS * ROWS + 1, BATCH))


def survives(a: np.ndarray, b: np.ndarray, need: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two signature matrices that no batch rules out, and their equal minima."""
    alive, equal = np.arange(len(a)), np.zeros(len(a), dtype=np.int64)
    for k, least in enumerate(need):
        part = slice(k * BATCH, (k + 1) * BATCH)
        equal[alive] += (a[alive, part] == b[alive, part]).sum(axis=1)
        alive = alive[equal[alive] >= least]
    return alive, equal[alive]


def _likely(pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) left by the sequential comparison of their signatures,
    for every b the one with most equal minima."""
    need = least_matches(percent)
    wide = (pairs.join(sigs.select(F.col("class").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sigs.select(F.col("class").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb"))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), dtype=np.uint16).reshape(b.num_rows, -1) for k in (2, 3))
            at, equal = survives(x, y, need)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array(equal)],
                                             ["a", "b", "equal"])
    return (wide.mapInArrow(run, "a binary, b binary, equal long").groupBy("b")
            .agg(F.max(F.struct("equal", "a"))["a"].alias("a")).select("a", "b"))


def _verified(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Pairs whose complete shingle sets reach the threshold."""
    wide = (pairs.join(texts.select(F.col("class").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("class").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))

    def run(batches):
        last: tuple = (None, None)
        for b in batches:
            keep = []
            for k in range(b.num_rows):
                one = b.column(0)[k].as_py()
                if last[0] != one:
                    last = (one, shingles(b.column(2)[k].as_py(), width))
                x, y = last[1], shingles(b.column(3)[k].as_py(), width)
                both = len(x & y)
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return wide.mapInArrow(run, "a binary, b binary")


# ------------------------------------------------------------- the whole
def _features(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), *row_key(id_col, text_col), utf8(text_col).alias("text"))
    id_sql = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            n, cls, sigs = [], [], []
            for t in b.column(3):
                s, digest = shingle_hashes(t.as_py(), width)
                n.append(s.size)
                cls.append(digest or None)
                sigs.append(signature(s).tobytes() if digest else None)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(sigs, pa.binary())],
                ["id", "k1", "k2", "n_shingles", "class", "sig"])
    return rows.mapInArrow(run, f"id {id_sql}, k1 long, k2 long, n_shingles long, class binary, sig binary")


def _bands(sigs: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.concatenate([band_keys(np.frombuffer(s, dtype=np.uint16)) for s in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), BANDS))),
                                              pa.array(keys)], ["class", "key"])
    return sigs.select("class", "sig").mapInArrow(run, "class binary, key long")


def _still_open(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members with the component each is in so far, of buckets with several."""
    comp = components(links).select(F.col("id").alias("class"), F.col("label").alias("now"))
    named = (members.join(comp, "class", "left").withColumn("label", F.coalesce("now", "class"))
             .select("key", "class", "meets", "label"))
    parted = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    return named.join(parted.select("key"), "key")


def _leader_pairs(members: DataFrame, turn: int) -> DataFrame:
    """One pair per member that is in another component than its bucket's leader.

    Even turns lead by the classes that meet most others (the middle of a group
    of near copies shares more bands with all of them than they do), odd turns
    by a hash.
    """
    by = -F.col("meets") if turn % 2 == 0 else F.xxhash64(F.lit(turn), "class")
    lead = members.groupBy("key").agg(F.min(F.struct(by.alias("o"), F.col("class").alias("a"), F.col("label").alias("l"))).alias("lead"))
    return (members.join(lead, "key").where(F.col("label") != F.col("lead.l"))
            .select(F.col("lead.a").alias("a"), F.col("class").alias("b")).distinct())


def _jobs(batches):
    """(job, its rows as one table) from batches sorted by their first column."""
    job, parts = None, []
    for b in batches:
        if not b.num_rows:
            continue
        ids = b.column(0).to_numpy()
        cut = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), b.num_rows]
        for at, end in zip(cut, cut[1:]):
            if parts and ids[at] != job:
                yield job, pa.Table.from_batches(parts)
                parts = []
            job = ids[at]
            parts.append(b.slice(at, end - at))
    if parts:
        yield job, pa.Table.from_batches(parts)


def _crossing_links(members: DataFrame, sigs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Links between a bucket's members that are in different components.

    Members outside a bucket's largest component meet all others.  Both sides
    are cut into blocks of about ``BLOCK``; a job compares two blocks, so no
    candidate becomes a row.  A pair that shares several bands is compared under
    the first of them only (that bucket is open as well).  A job's survivors
    go on as one row per class with its partners, get their texts, and are
    verified job by job.
    """
    need = least_matches(percent)
    every = save(members.select("key", "class", "label").join(sigs.select("class", "size", "sig"), "class"), "near-crossing")
    per = every.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    top = (per.groupBy("key").agg(F.max(F.struct("n", "label")).alias("t"), F.sum("n").alias("all"))
           .select("key", F.col("t.label").alias("top"), F.ceil((F.col("all") - F.col("t.n")) / BLOCK).alias("rows"),
                   F.ceil(F.col("all") / BLOCK).alias("cols")))
    sized = every.join(top, "key").withColumn("out", F.col("label") != F.col("top"))
    row, col = F.pmod(F.xxhash64("class", F.lit(1)), F.col("rows")), F.pmod(F.xxhash64("class", F.lit(2)), F.col("cols"))
    kept = ("key", "class", "label", "out", "size", "sig")
    asks = sized.where("out").select(*kept, F.lit(True).alias("asks"), row.alias("i"),
                                     F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("j"))
    meets = sized.select(*kept, F.lit(False).alias("asks"), col.alias("j"),
                         F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"))
    dealt = asks.unionByName(meets).select(F.xxhash64("key", "i", "j").alias("job"), "asks", *kept)

    def compare(batches):
        for job, t in _jobs(batches):
            sig = np.frombuffer(b"".join(t.column(7).to_pylist()), dtype=np.uint16).reshape(t.num_rows, -1)
            asks, out, size = (t.column(k).to_numpy() for k in (1, 5, 6))
            left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
            if not left.size or not right.size:
                continue
            band = int(np.flatnonzero(band_keys(sig[0]) == t.column(2)[0].as_py())[0])
            cls, label = t.column(3).to_pylist(), np.array(t.column(4).to_pylist(), dtype=object)
            partners: dict[bytes, list[bytes]] = {}
            for x in left:
                at = right[(label[right] != label[x]) & (100 * np.minimum(size[right], size[x]) >= percent * np.maximum(size[right], size[x]))]
                # of two members outside the largest component, one asks
                at = np.array([y for y in at if not out[y] or cls[x] < cls[y]], dtype=np.int64)
                if at.size:
                    shared = (sig[at] == sig[x]).reshape(at.size, BANDS, ROWS).all(axis=2)
                    at = at[shared.argmax(axis=1) == band]
                    at = at[survives(np.broadcast_to(sig[x], (at.size, sig.shape[1])), sig[at], need)[0]]
                if at.size:
                    partners[cls[x]] = [cls[y] for y in at]
                    for y in partners[cls[x]]:
                        partners.setdefault(y, [])
            if partners:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(partners), job)), pa.array(partners.keys(), pa.binary()),
                                                  pa.array(partners.values(), pa.list_(pa.binary()))], ["job", "class", "partners"])

    def confirm(batches):
        for _, t in _jobs(batches):
            text, sets, held = dict(zip(t.column(1).to_pylist(), t.column(3).to_pylist())), {}, 0

            def of(c):
                nonlocal held
                if c not in sets:
                    found = shingles(text[c], width)
                    held += len(found)
                    if held > HELD:
                        sets.clear()
                        held = len(found)
                    sets[c] = found
                return sets[c]
            links = []
            for a, partners in zip(t.column(1).to_pylist(), t.column(2).to_pylist()):
                for b in partners:
                    x, y = of(a), of(b)
                    both = len(x & y)
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        links.append((a, b))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*links)], ["a", "b"])

    likely = save(dealt.repartition("job").sortWithinPartitions("job")
                  .mapInArrow(compare, "job long, class binary, partners array<binary>"), "near-likely")
    asked = likely.join(texts, "class").select("job", "class", "partners", "text")
    return asked.repartition("job").sortWithinPartitions("job").mapInArrow(confirm, "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """Row per input row: id, n_shingles, component_id, kept, n_links (verified
    links of the row's class to other classes), and for joining rows back k1,
    k2 (``row_key``) and ``stays``: exactly one row key of each component does,
    and every row without shingles.

    component_id is the smallest id reachable over links.  Null and empty texts
    have no shingles, are linked with nothing and keep themselves.  Rows with
    the same word sequence are one class (so are repeated rows); a null id
    takes part without naming a component, and is kept only when no id is
    reachable.  An empty table gives an empty result.
    """
    features = save(_features(docs, id_col, text_col, width), "near-features")
    reps = (features.where(F.col("class").isNotNull()).groupBy("class")
            .agg(F.min(F.struct("k1", "k2")).alias("row")))
    sigs = save(features.join(reps.select("class", "row.k1", "row.k2"), ["class", "k1", "k2"]).groupBy("class")
                .agg(F.first("sig").alias("sig"), F.first("n_shingles").alias("size"), F.first("k1").alias("k1"),
                     F.first("k2").alias("k2")), "near-classes")
    bands = _bands(sigs)
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = save(bands.join(shared, "key"), "near-members")
    # how many others a class meets in its buckets
    met = members.groupBy("class").agg(F.sum("n").alias("meets"))
    members = save(members.join(met, "class").select("key", "class", "meets", F.col("class").alias("label")), "near-met")
    # texts of the classes that have a candidate
    asked = save(members.select("class").distinct().join(sigs.select("class", "k1", "k2"), "class"), "near-asked")
    rows = docs.select(*row_key(id_col, text_col), utf8(text_col).alias("text"))
    texts = save(keep_probable(rows, "k1", bounded_filter(asked, "k1")).join(asked, ["k1", "k2"])
                 .groupBy("class").agg(F.first("text").alias("text")), "near-texts")

    links = None

    def add(found):
        nonlocal links
        found = save(found, "near-links")
        links = found if links is None else links.unionByName(found)
    for turn in range(LEADER_ROUNDS):
        pairs = save(_likely(_leader_pairs(members, turn), sigs, percent), "near-likely")
        add(_verified(pairs, texts, percent, width))
        members = save(_still_open(members, links), "near-open")     # closed buckets have nothing more to offer
    add(_crossing_links(members, sigs, texts, percent, width))
    links = save(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near-all-links")

    comp = components(links).select(F.col("id").alias("class"), "label")
    degree = (links.select(F.col("a").alias("class")).unionByName(links.select(F.col("b").alias("class")))
              .groupBy("class").agg(F.count(F.lit(1)).alias("n_links")))
    lowest = F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")
    per_class = (features.where(F.col("class").isNotNull()).groupBy("class").agg(F.min(lowest).alias("low"))
                 .join(comp, "class", "left").join(degree, "class", "left")
                 .select("class", "low", F.coalesce("label", "class").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    named = save(per_class.join(per_class.groupBy("label").agg(F.min("low").alias("stay")), "label")
                 .select("class", "stay", "n_links"), "near-named")
    # a class may hold a third of all rows: an inner join, whose large partitions are split
    some = features.where(F.col("class").isNotNull()).drop("sig").join(named, "class").select(
        "id", "n_shingles", F.col("stay.id").alias("component_id"), "n_links", "k1", "k2",
        ((F.col("k1") == F.col("stay.k1")) & (F.col("k2") == F.col("stay.k2"))).alias("stays"))
    none = features.where(F.col("class").isNull()).select(
        "id", "n_shingles", F.col("id").alias("component_id"), F.lit(0).cast("long").alias("n_links"), "k1", "k2",
        F.lit(True).alias("stays"))
    return some.unionByName(none).select(
        F.col("id").alias(id_col), "n_shingles", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), "n_links", "k1", "k2", "stays")
