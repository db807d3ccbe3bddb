"""Filter interaction audit by higher-order SQL folds.

Which filter removes what depends on the order in which filters run.  Five
filters are audited under all 120 orders at once, from one pass over the texts:

1. every document becomes a five-bit *mask* of the filters that it fails;
2. documents are counted per (part, mask) cell -- at most 32 cells a part, with
   partial sums in every map task, so a part of any size costs no more;
3. each cell folds over the literal array of all orders: ``transform`` over the
   orders, ``aggregate`` over the five filters of each, giving 600 structs
   weighted with the cell's counts;
4. the cells of a part (32 at most) are merged by elementwise sums.

Failure conditions (words: maximal runs of other than space and \\x09-\\x0D):
A under 200 words; B 100 * distinct words < 50 * words; C 100 * ``[A-Z]``
characters > 2 * code points; D holds any of ``#$%&*|``; E the same text stands
in a row of smaller doc_id, whatever its part and whatever else removes it.

Odd input: a null text is the empty text (fails A, and E behind another empty
one); a null part is the empty string, and shares its rows with it; a row
without doc_id is never a copy and has no label; repeated rows of one doc_id
are documents of their own and no copies of each other; of several labels of a
doc_id one with quality (toxic) 1 is enough; an empty table gives no rows.
Texts are held equal by their SHA-256.  Long texts are read whole.
"""

from __future__ import annotations

import hashlib
import re
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, save

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_STEPS = "array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_NOT_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_MARK = bytes(b for b in range(256) if b not in b"#$%&*|")
_LONG = 1 << 20         # longer texts are walked word by word: only the distinct words are held


def text_mask(text: str) -> tuple[int, bytes]:
    """The bits of A to D, and the SHA-256 of the text."""
    data = text.encode("utf-8", "surrogatepass")
    if len(data) <= _LONG:
        words = data.split()                    # bytes split at space and \x09-\x0D
        n, distinct = len(words), len(set(words))
    else:
        n, seen = 0, set()
        for m in _WORD.finditer(data):
            n += 1
            seen.add(m.group())
        distinct = len(seen)
    capitals, marks = len(data.translate(None, _NOT_CAPITAL)), len(data.translate(None, _NOT_MARK))
    fails = (n < 200, 100 * distinct < 50 * n, 100 * capitals > 2 * len(text), marks > 0)
    return sum(1 << i for i, f in enumerate(fails) if f), hashlib.sha256(data).digest()


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, mask): bit i of the mask is set where filter ``FILTERS[i]`` fails."""
    rows = pick(docs, id=id_col, text=text_col, part=part_col)
    rows = rows.select("id", F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, part string, mask int, digest binary"

    def read(batches):
        for b in batches:
            found = [text_mask(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([m for m, _ in found], pa.int32()),
                                              pa.array([d for _, d in found], pa.binary())],
                                             ["id", "part", "mask", "digest"])

    # written once without the texts, which are read a single time
    rows = save(rows.mapInArrow(read, schema), "audit-masks")
    first = (rows.groupBy("digest").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    copy = F.when(F.col("id") > F.col("first_id"), 1 << 4).otherwise(0)
    return rows.join(first, "digest", "left").select("id", "part", (F.col("mask") + copy).alias("mask"))


def cells(masked: DataFrame, labels: DataFrame, id_col: str = "doc_id", good_col: str = "quality",
          toxic_col: str = "toxic") -> DataFrame:
    """(part, mask, n, good, toxic): documents of every occurring cell."""
    marks = (pick(labels, id=id_col, good=good_col, toxic=toxic_col).where("id IS NOT NULL")
             .groupBy("id").agg(F.max(F.when(F.col("good") == 1, 1).otherwise(0)).alias("good"),
                                F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    return (masked.join(marks, "id", "left").groupBy("part", "mask")
            .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                 F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))


def _fold(order: Column) -> Column:
    """Five structs of one cell under one order (an array of filter bits)."""
    def weigh(test: Column, weight: str, name: str) -> Column:
        return F.when(test, F.col(weight)).otherwise(F.lit(0)).cast("long").alias(name)

    def step(acc: Column, bit: Column) -> Column:
        fails = F.col("mask").bitwiseAND(bit) != 0
        here, on = acc["alive"] & fails, acc["alive"] & ~fails
        row = F.struct(weigh(on, "n", "kept"), weigh(here, "n", "removed"), weigh(~acc["alive"] & fails, "n", "redundant"),
                       weigh(F.col("mask") == bit, "n", "unique_fails"), weigh(here, "good", "good_lost"),
                       weigh(here, "toxic", "toxic_lost"))
        return F.struct(on.alias("alive"), F.concat(acc["rows"], F.array(row)).alias("rows"))

    start = F.struct(F.lit(True).alias("alive"), F.array().cast(_STEPS).alias("rows"))
    return F.aggregate(order, start, step, lambda acc: acc["rows"])


def _add(a: Column, b: Column) -> Column:
    return F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS])


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step; see the module.

    Result: part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley (the step's filter's ``removed`` summed over
    all orders, at any step).
    """
    orders = F.array(*[F.array(*[F.lit(1 << FILTERS.index(f)) for f in o]) for o in ORDERS])
    counted = cells(masks(docs, id_col, text_col, part_col), labels)
    folded = counted.select("part", F.flatten(F.transform(orders, _fold)).alias("steps"))
    merged = (folded.groupBy("part").agg(F.collect_list("steps").alias("cells"))       # 32 cells at most
              .select("part", F.aggregate(F.slice("cells", 2, 32), F.col("cells")[0],
                                          lambda acc, x: F.zip_with(acc, x, _add)).alias("steps")))
    letters = F.array(*[F.lit(f) for o in ORDERS for f in o])
    shares = F.transform(F.array(*[F.lit(f) for f in FILTERS]), lambda f: F.aggregate(
        F.zip_with("steps", letters, lambda s, x: F.when(x == f, s["removed"]).otherwise(F.lit(0).cast("long"))),
        F.lit(0).cast("long"), lambda acc, x: acc + x))
    # the shares are taken before the rows are spread, once a part
    merged = merged.select("part", "steps", shares.alias("shares"))
    rows = merged.select("part", "shares", F.posexplode_outer("steps").alias("at", "row"))
    order = F.element_at(F.array(*[F.lit(o) for o in ORDERS]), (F.floor(F.col("at") / 5) + 1).cast("int"))
    rows = rows.select("part", "shares", "row", order.alias("filter_order"), (F.col("at") % 5 + 1).alias("step"))
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    return rows.select("part", "filter_order", F.col("step").cast("int").alias("step"), "row.*",
                       F.element_at("shares", F.ascii(letter) - 64).alias("shapley"))
