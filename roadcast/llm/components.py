"""Connected components by contraction of the edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import save


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every id in ``links`` (a, b); label: the smallest id reachable.

    Each round moves every vertex to the first of itself and its neighbours
    under a hash order, replaces the ends of the edges by where they moved, and
    drops inner and repeated edges, so the edges of a round are those between
    groups that have not met.  A star is gone after two rounds of one order; a
    new order every second round leaves, whatever the graph, a constant share of
    the vertices in the mean.  Rounds are tables in the shared folder; only a
    count comes to the driver.  Links of a vertex with itself count as none; a
    vertex without other links has no row.
    """
    spark = links.sparkSession
    edges = save(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    state, turn = None, 0
    while True:
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn // 2), c).alias("o"), F.col(c).alias("to"))
        near = (edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                .groupBy(F.col("a").alias("id")).agg(F.min(rank("b")).alias("near")))
        step = save(near.select("id", F.least(rank("id"), "near")["to"].alias("to")), f"cc-step-{turn}")
        if state is None:
            state = step.withColumnRenamed("to", "label")
        else:
            state = save(state.join(step.withColumnRenamed("id", "label"), "label", "left")
                         .select("id", F.coalesce("to", "label").alias("label")), f"cc-{turn}")
        watch = Observation(f"cc-{scratch_path(spark, 'o').rsplit('-', 1)[-1]}")
        ends = (edges.join(step.select(F.col("id").alias("a"), F.col("to").alias("x")), "a")
                .join(step.select(F.col("id").alias("b"), F.col("to").alias("y")), "b"))
        edges = save(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
                     .observe(watch, F.count(F.lit(1)).alias("left")), f"cc-edges-{turn}")
        turn += 1
        if not watch.get["left"]:
            low = state.groupBy("label").agg(F.min("id").alias("low"))
            return state.join(low, "label").select("id", F.col("low").alias("label"))
