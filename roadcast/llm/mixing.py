"""Operator 8: mixing sources to target weights by a low-discrepancy schedule.

Each source is a shuffled stream of tokens cut into blocks of equal token
count.  Slot i of the mix belongs to the source under frac(i * golden ratio)
on the line of cumulative target weights; the slots of a source are ranked and
its r-th slot takes its r-th block (starting over at the end of the stream).
The golden ratio's points are spread so evenly that any stretch of the
schedule holds each source near its weight.  Every row carries its places:
the slots that take words of it and where in the slot they stand, so ordering
by (at, from) gives the mix.

The last block of a source is cut to what its target still needs, so the words
taken equal the rounded target; a source whose points have not come up often
enough when the schedule ends gets its remaining slots at the end.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save

GOLDEN = 0.6180339887498949
BLOCK_TOKENS = 4096
PIECES = 1024


def target_sizes(sizes: Sequence[int], weights: Sequence[float], share: float = 1.5,
                 ceiling: float = 2.0) -> list[float]:
    """Split ``share`` of all sizes by weight; a source stops at ``ceiling`` times
    its size and the excess goes to the others by weight, until none is above."""
    share, ceiling = Fraction(share), Fraction(ceiling)
    left, open_ = share * sum(sizes), set(range(len(sizes)))
    out = [Fraction(0)] * len(sizes)
    while open_:
        total = sum(Fraction(weights[i]) for i in open_)
        want = {i: left * Fraction(weights[i]) / total for i in open_}
        over = [i for i in open_ if want[i] > ceiling * sizes[i]]
        if not over:
            for i in open_:
                out[i] = want[i]
            break
        for i in over:
            out[i] = ceiling * sizes[i]
            left -= out[i]
            open_.remove(i)
    return [float(x) for x in out]


def word_count(c: str) -> Column:
    r"""Number of ``[^\x20\x09-\x0D]+`` runs; null counts 0."""
    return F.coalesce(F.regexp_count(F.col(c), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _streams(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``off``: words before the row in its source's shuffled stream.

    A two-level running sum: inside each of ``PIECES`` slices of the shuffle
    order, then over the slices, so no task orders a whole source.
    """
    rows = rows.withColumn("slice", F.shiftrightunsigned("shuffle", 64 - PIECES.bit_length() + 1).cast("int"))
    per = rows.groupBy("src_no", "slice").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("src_no").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("src_no", "slice", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = (Window.partitionBy("src_no", "slice").orderBy("shuffle", *keys)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("run", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(per, ["src_no", "slice"])
            .withColumn("off", F.col("base") + F.col("run")).drop("slice", "run", "base"))


def schedule(spark, plan: list[tuple[int, int, int]], block: int) -> DataFrame:
    """Slots of the mix: (src_no, nth, at) with ``nth`` < the slots a source needs.

    ``plan``: (source number, its size, its whole-word target) of the sources.
    """
    need = {no: _slots(size, target, block) for no, size, target in plan}
    total = sum(need.values())
    edges, acc = [], 0
    for no, _, _ in plan:
        acc += need[no]
        edges.append((acc / max(total, 1), no))
    point = F.expr(f"pmod(id * {GOLDEN}D, 1D)")
    def under(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(edges[lo][1])
        mid = (lo + hi) // 2
        return F.when(F.col("point") < F.lit(edges[mid][0]), under(lo, mid)).otherwise(under(mid + 1, hi))
    source = under(0, len(edges) - 1)
    # a few points more than slots, so that sources reach their number by points
    points = (spark.range(1, total + 1 + 4 * len(plan)).withColumn("point", point)
              .select(F.col("id").alias("at"), source.alias("src_no"),
                      F.floor(F.col("id") / 65536).alias("chunk")))
    per = points.groupBy("src_no", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("src_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("src_no", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = (points.withColumn("k", F.row_number().over(Window.partitionBy("src_no", "chunk").orderBy("at")) - 1)
              .join(per, ["src_no", "chunk"]).select("src_no", (F.col("base") + F.col("k")).alias("nth"), "at"))
    needed = spark.createDataFrame([(no, n) for no, n in need.items() if n], "src_no int, need long")
    came = ranked.groupBy("src_no").agg(F.count(F.lit(1)).alias("came"))
    late = (needed.join(came, "src_no", "left").withColumn("came", F.coalesce("came", F.lit(0)))
            .where("came < need")
            .select("src_no", F.explode(F.sequence("came", F.col("need") - 1)).alias("nth"))
            .withColumn("at", F.lit(1 << 62) + F.col("nth")))
    kept = ranked.join(F.broadcast(needed), "src_no").where("nth < need").select("src_no", "nth", "at")
    return kept.unionByName(late.select("src_no", "nth", "at"))


def _slots(size: int, target: int, block: int) -> int:
    """Blocks that hold ``target`` words of a stream of ``size`` read over and over."""
    if not target or not size:
        return 0
    whole, rest = divmod(target, size)
    return whole * -(-size // block) + -(-rest // block)


def mix(docs: DataFrame, weights: Sequence[float] = (3.0, 1.0, 2.0), share: float = 1.5, ceiling: float = 2.0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block_tokens: int = BLOCK_TOKENS, keep: Sequence[str] = ()) -> DataFrame:
    """Row per input row: id, size, source_size, target, taken, places (and, for
    the pipeline, ``first`` / ``second``: words taken in the first and later passes).

    ``places``: for each slot with words of the row, in the order of the mix, the
    slot's place ``at`` in the schedule, the words of the slot before the row's
    (``from``), the pass (``turn``) and the ``words`` taken; empty when none are.

    Sources order by code point, null last, and take ``weights`` in turn.  The
    list of sources and their sizes comes to the driver: it is the mix's own
    configuration.  Null texts and empty texts have size 0 and take nothing; a
    null id shuffles like any other value; repeated rows are separate members
    of the stream.  An empty table gives an empty result.
    """
    rows = save(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                            word_count(text_col).alias("size"),
                            F.xxhash64(F.lit(8), F.col(id_col), F.col(text_col)).alias("shuffle"),
                            *[F.col(c).alias(f"keep_{c}") for c in keep]), "mix-rows")
    sources = sorted(((r["source"], r["n"] or 0) for r in
                      rows.groupBy("source").agg(F.sum("size").alias("n")).collect()),
                     key=lambda s: (s[0] is None, s[0] or ""))
    sizes = [n for _, n in sources]
    targets = target_sizes(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, ceiling)
    whole = [min(int(t + 0.5), int(ceiling * n)) for t, n in zip(targets, sizes)]
    # equal blocks, small enough that the smallest source still has some hundred
    # and that the schedule has at most a slot per document
    spark = docs.sparkSession
    plan = [(i, n, w) for i, (n, w) in enumerate(zip(sizes, whole))]
    smallest = min((w for w in whole if w), default=1)
    block = max(1, min(block_tokens, max(smallest // 128, sum(whole) // 1_000_000)))
    table = spark.createDataFrame([(s, i, n, t) for i, ((s, n), t) in enumerate(zip(sources, targets))],
                                  "source string, src_no int, source_size long, target double")
    rows = rows.join(F.broadcast(table), rows["source"].eqNullSafe(table["source"])).drop("source")
    if not rows.columns or not plan or not sum(whole):
        streams = rows.withColumn("off", F.lit(0).cast("long"))
        slots = spark.createDataFrame([], "src_no int, nth long, at long")
    else:
        streams, slots = _streams(rows, ["id", "size"]), schedule(spark, plan, block)
    sized = spark.createDataFrame([(i, n, w, -(-n // block)) for i, n, w in plan if n],
                                  "src_no int, words long, want long, blocks long")
    # a slot takes [from, to) of its source's stream in pass ``turn``
    taken = (slots.join(F.broadcast(sized), "src_no")
             .withColumn("turn", F.floor(F.col("nth") / F.col("blocks")))
             .withColumn("block", F.col("nth") % F.col("blocks"))
             .select("src_no", "block", "turn", "at", F.least(
                 F.least((F.col("block") + 1) * block, F.col("words")),
                 F.col("want") - F.col("turn") * F.col("words")).alias("to")))
    # per block: how far the first pass goes, and the later ones together
    blocks = taken.groupBy("src_no", "block").agg(
        F.collect_list(F.struct("turn", "at", "to")).alias("passes"))      # one entry per pass: at most ceil(ceiling)
    streams = save(streams.withColumn("row", F.xxhash64("shuffle", "off")), "mix-streams")
    pieces = streams.where("size > 0").select(
        "src_no", "off", "size",
        F.explode(F.sequence(F.floor(F.col("off") / block), F.floor((F.col("off") + F.col("size") - 1) / block))).alias("block"))

    def overlap(p: Column) -> Column:
        start = F.greatest(F.col("off"), F.col("block") * block)
        end = F.least(F.col("off") + F.col("size"), (F.col("block") + 1) * block, p["to"])
        return F.greatest(F.lit(0), end - start)
    place = F.struct("at", F.col("from").cast("long").alias("from"), F.col("turn").cast("int").alias("turn"),
                     F.col("w").cast("long").alias("words"))
    none = F.array().cast("array<struct<at:long,from:long,turn:int,words:long>>")
    got = (pieces.join(blocks, ["src_no", "block"])
           .select("src_no", "off", F.explode("passes").alias("p"), "size", "block")
           .select("src_no", "off", F.col("p.turn").alias("turn"), F.col("p.at").alias("at"), overlap(F.col("p")).alias("w"),
                   (F.greatest(F.col("off"), F.col("block") * block) - F.col("block") * block).alias("from"))
           .groupBy("src_no", "off").agg(F.sum(F.when(F.col("turn") == 0, F.col("w")).otherwise(0)).alias("first"),
                                         F.sum(F.when(F.col("turn") > 0, F.col("w")).otherwise(0)).alias("second"),
                                         F.array_sort(F.collect_list(F.when(F.col("w") > 0, place))).alias("places")))
    # rows without words share an offset with the next row: they take nothing
    zero = F.col("size") == 0
    return (streams.join(got, ["src_no", "off"], "left")
            .select(F.col("id").alias(id_col), "size", "source_size", "target",
                    F.when(zero, 0).otherwise(F.coalesce(F.col("first") + F.col("second"), F.lit(0))).cast("long").alias("taken"),
                    F.when(zero, none).otherwise(F.coalesce("places", none)).alias("places"),
                    F.when(zero, 0).otherwise(F.coalesce("first", F.lit(0))).cast("long").alias("first"),
                    F.when(zero, 0).otherwise(F.coalesce("second", F.lit(0))).cast("long").alias("second"),
                    *[F.col(f"keep_{c}").alias(c) for c in keep]))
