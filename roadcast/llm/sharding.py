"""Operator 9: sharding by sampled splitters (DataFrame functions only).

Records are ordered by (hash of the text, hash of the id), cut into ranges and
laid end to end; a record's shard is the place of its bytes on that line, so
shard sizes are near equal and equal texts stay together unless a group alone
is overfull.

1. A size-weighted sample is drawn (each record races with an exponential
   clock of rate size; the first ``sample`` win) and its quantiles of the key
   are the splitters.
2. Exact bytes per range follow.  An overfull range is subdivided evenly in
   the key; a single text above the limit gets ranges of its own, subdivided
   in the hash of the id.  So no task ever orders more than a few limits.
3. Prefix sums over the cells' bytes and rows, plus a running sum inside each
   cell, place every record.  Groups of equal texts inside a cell take the
   shard of the group's middle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save

SPLITTERS = 63
SAMPLE = 8192
CELL_BYTES = 128 << 20


def _range_of(key: Column, cuts: list[int]) -> Column:
    """Index of the range that holds ``key``: a binary search as nested conditions."""
    def below(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < F.lit(cuts[mid]), below(lo, mid)).otherwise(below(mid + 1, hi))
    return below(0, len(cuts))


def _even(key: Column, lo: Column, hi: Column, parts: Column) -> Column:
    """Which of ``parts`` equal pieces of [lo, hi] holds ``key``; monotone in key."""
    part = F.floor((key.cast("double") - lo.cast("double"))
                   / (hi.cast("double") - lo.cast("double") + 1.0) * parts)
    return F.greatest(F.lit(0), F.least(part, parts - 1)).cast("int")


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                   sample: int = SAMPLE, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """Row per input row: id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    Size is the UTF-8 bytes of the text plus 1 (null text: 1, crc32 of nothing).
    ``slot`` numbers a shard's records from 0 without gaps.  ``sample`` bounds
    the rows the driver sees; ``cell_bytes`` bounds what one task orders.  Rows
    that repeat (same id and text) get slots of their own; which of them gets
    which is not told apart by any column.  Null ids order first within their
    group.  An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"),
                       F.xxhash64(F.lit(9), F.col(id_col)).alias("d"),
                       (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("crc"))
    rows = save(rows, "shard-rows")                      # no texts from here on
    total = rows.agg(F.sum("size")).first()[0] or 0
    # splitters: equal steps through a size-weighted sample of the keys
    unit = (F.xxhash64(F.lit(23), "h", "d").bitwiseAND(F.lit((1 << 52) - 1)) + 1) / F.lit(float(1 << 52))
    drawn = sorted(r[0] for r in rows.select("h", (-F.log(unit) / F.col("size")).alias("race"))
                   .orderBy("race", "h").limit(sample).collect())
    cuts = sorted({drawn[len(drawn) * i // (SPLITTERS + 1)] for i in range(1, SPLITTERS + 1)}) if drawn else []
    limit = max(1, min(cell_bytes, total // 256))

    rows = rows.withColumn("range", _range_of(F.col("h"), cuts))
    by_text = rows.groupBy("range", "h").agg(F.sum("size").alias("group_bytes"))
    hot = (by_text.where(F.col("group_bytes") > limit)
           .select("range", "h", F.ceil(F.col("group_bytes") / limit).alias("hot_parts")))
    # at most SPLITTERS + 1 rows
    width = (by_text.groupBy("range").agg(
        F.min("h").alias("lo"), F.max("h").alias("hi"),
        F.ceil(F.sum(F.when(F.col("group_bytes") <= limit, F.col("group_bytes")).otherwise(0)) / limit).alias("parts")))
    low, high = F.lit(-(1 << 63)), F.lit((1 << 63) - 1)
    cell = ["range", "hot", "part"]
    celled = (rows.join(hot, ["range", "h"], "left").join(F.broadcast(width), "range")
              .select("id", "h", "d", "size", "crc", "range",
                      F.when(F.col("hot_parts").isNull(), low).otherwise(F.col("h")).alias("hot"),
                      F.when(F.col("hot_parts").isNull(), _even(F.col("h"), F.col("lo"), F.col("hi"),
                                                                F.greatest(F.col("parts"), F.lit(1))))
                      .otherwise(_even(F.col("d"), low, high, F.col("hot_parts"))).alias("part")))
    sums = celled.groupBy(*cell).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy("range").orderBy("hot", "part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sums.groupBy("range").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))   # <= 64 rows
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("b0"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    cells = (sums.join(F.broadcast(starts), "range")
             .select(*cell, (F.col("b0") + F.coalesce(F.sum("bytes").over(inside), F.lit(0))).alias("b0"),
                     (F.col("n0") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("n0")))
    in_cell = Window.partitionBy(*cell).orderBy("h", "d", "id", "size")
    run = in_cell.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*cell, "h")
    placed = (celled.withColumn("run", F.coalesce(F.sum("size").over(run), F.lit(0)))
              .withColumn("nth", F.row_number().over(in_cell) - 1)
              .withColumn("group_at", F.min("run").over(group))
              .withColumn("group_len", F.sum("size").over(group))
              .join(cells, cell))
    middle = F.when(F.col("hot") == low, F.col("group_at") + F.col("group_len") / 2) \
        .otherwise(F.col("run") + F.col("size") / 2) + F.col("b0")
    placed = save(placed.select(
        "id", "size", "crc", (F.col("n0") + F.col("nth")).alias("rank"),
        F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(max(total, 1)))).cast("int").alias("shard")),
        "shard-placed")
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))                          # <= shards rows
    return (placed.join(F.broadcast(first), "shard")
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                    "shard", (F.col("rank") - F.col("first")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
