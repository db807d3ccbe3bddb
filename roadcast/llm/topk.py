"""Operator 4: exact top-k inner-product search by dual cover trees.

Queries and data share one top level: a bounded number of centres drawn from
the vectors.  Every vector belongs to its nearest centre; a node's covering
radius is the largest distance of its members, taken over all of them.  For a
query node (centre q, radius s) and a data node (centre r, radius t) no member
pair scores above

    <q, r> + s |r| + t |q| + s t .

1. Each query node first meets the data nodes with the highest bounds; that
   gives every query a k-th best score, and the node the worst of them.
2. Node pairs whose bound is below that worst score are pruned; the others
   meet.  Nodes are cut into blocks, so a pair of blocks is what one task
   holds at a time, whatever a node's size.
3. Inside a pair of blocks both sides are cover trees (radii halve from level
   to level) that are walked together with the same bound, the group's worst
   k-th score rising on the way.

Equal vectors are one point with its k + 1 smallest ids: no other copy can be
among a query's k best.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save

CENTRES = 64
FIRST_NODES = 3
BLOCK = 4096
LEAF = 48


# ------------------------------------------------------------- cover trees
class CoverTree:
    """Levels of centres with halving radii over rows ``at`` of ``points``.

    ``radius`` is the exact largest distance from the centre to a member.
    """

    __slots__ = ("at", "centre", "radius", "norm", "children")

    def __init__(self, points: np.ndarray, at: np.ndarray, centre: int | None = None):
        if centre is None:                      # the member nearest to the mean
            mean = points[at].mean(axis=0)
            centre = int(at[((points[at] - mean) ** 2).sum(axis=1).argmin()])
        d = np.sqrt(((points[at] - points[centre]) ** 2).sum(axis=1))
        self.at, self.centre, self.radius = at, points[centre], float(d.max())
        self.norm = float(np.sqrt((points[centre] ** 2).sum()))
        self.children: list[CoverTree] = []
        if at.size <= LEAF or self.radius == 0:
            return
        # greedy cover at half the radius: each new centre is farther than that from all before
        near, whose, centres = d, np.zeros(at.size, dtype=np.int64), [centre]
        while len(centres) < 16 and near.max() > self.radius / 2:
            new = int(near.argmax())
            centres.append(int(at[new]))
            dist = np.sqrt(((points[at] - points[at[new]]) ** 2).sum(axis=1))
            closer = dist < near
            whose[closer], near = len(centres) - 1, np.minimum(near, dist)
        if len(centres) > 1:
            self.children = [CoverTree(points, at[whose == k], c) for k, c in enumerate(centres)]


def bound(q: CoverTree, r: CoverTree) -> float:
    """No query of ``q`` scores higher with a point of ``r`` (with room for rounding)."""
    return (float(q.centre @ r.centre) + q.radius * r.norm + r.radius * q.norm + q.radius * r.radius) * 1.0 + 1e-6 * (
        1 + (q.norm + q.radius) * (r.norm + r.radius))


class Best:
    """The k best (score, smallest id) of each query of a block."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.k, self.score = k, np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.floor = np.full(n, -np.inf) if floor is None else floor

    def worst(self, at: np.ndarray) -> float:
        return float(np.maximum(self.score[at, -1], self.floor[at]).min())

    def offer(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """``score``: query by candidate; ``ids``: of the candidates, per query."""
        s = np.concatenate([self.score[at], score], axis=1)
        i = np.concatenate([self.ids[at], ids], axis=1)
        order = np.lexsort((i, -s), axis=1)[:, :self.k]
        self.score[at], self.ids[at] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def walk(q: CoverTree, r: CoverTree, queries: np.ndarray, own: np.ndarray, points: np.ndarray,
         ids: np.ndarray, best: Best) -> None:
    """Visit the pair of nodes unless its bound is below every query's k-th score."""
    if bound(q, r) < best.worst(q.at):
        return
    if not r.children and not q.children:
        score = queries[q.at] @ points[r.at].T
        # an equal vector stands for up to k + 1 ids; the query's own is no candidate
        copies = ids.shape[1]
        cand = np.broadcast_to(ids[r.at].reshape(1, -1), (q.at.size, r.at.size * copies))
        score = np.repeat(score, copies, axis=1)
        score[(cand == own[q.at][:, None]) | (cand == np.iinfo(np.int64).max)] = -np.inf
        cand = np.where(np.isneginf(score), np.iinfo(np.int64).max, cand)
        best.offer(q.at, score, cand)
        return
    if r.children and (not q.children or r.radius >= q.radius):
        for child in sorted(r.children, key=lambda c: -bound(q, c)):
            walk(q, child, queries, own, points, ids, best)
    else:
        for child in q.children:
            walk(child, r, queries, own, points, ids, best)


# ------------------------------------------------------------- on tables
def whole_vectors(table: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(id, v): floor(scale * component) as doubles; rows with a null id, a null
    vector, no component, or a null or non-finite component are left out."""
    v = F.transform(F.col(vec_col).cast("array<double>"), lambda x: F.floor(x * scale).cast("double"))
    bad = F.exists(F.col(vec_col).cast("array<double>"),
                   lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias(vec_col))
            .where(F.col("id").isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0))
            .where(~F.coalesce(bad, F.lit(False))).select("id", v.alias("v")))


def _nearest(centres: np.ndarray):
    half = (centres ** 2).sum(axis=1) / 2

    def run(batches):
        for pdf in batches:
            v = np.stack(pdf["v"].to_numpy()) if len(pdf) else np.zeros((0, centres.shape[1]))
            node = (v @ centres.T - half).argmax(axis=1) if len(pdf) else np.zeros(0, dtype=np.int64)
            d = np.sqrt(((v - centres[node]) ** 2).sum(axis=1))
            yield pdf.assign(node=node.astype("int32"), dist=d)
    return run


def topk(table: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding",
         scale: float = 256.0, centres: int = CENTRES, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer inner products.

    Queries are the rows whose id is divisible by ``every``; candidates are all
    rows but those with the query's id; ties go to the smaller id.  Vectors
    whose length differs from the most common one's are not comparable and
    raise.  Ids should be unique; of rows that repeat an id with the same
    vector one counts.  ``centres`` bounds what the driver holds.
    """
    spark = table.sparkSession
    empty = "query_id long, rank int, vec_id long, score long"
    vectors = whole_vectors(table, id_col, vec_col, scale).dropDuplicates(["id", "v"])
    # equal vectors: the k + 1 smallest ids (cut before the shuffle, task by task)
    few = Window.partitionBy("v").orderBy("id")
    points = (vectors.withColumn("n", F.row_number().over(few)).where(F.col("n") <= k + 1)
              .groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    points = save(points.withColumn("h", F.xxhash64("v")), "topk-points")
    head = points.orderBy("h").limit(centres).toPandas()                       # bounded: ``centres`` rows
    if not len(head):
        return spark.createDataFrame([], empty)
    if points.where(F.size("v") != len(head["v"][0])).limit(1).count():
        raise ValueError("vectors of different lengths")
    mid = np.stack(head["v"].to_numpy())
    n_nodes = len(mid)
    points = save(points.mapInPandas(_nearest(mid), "v array<double>, ids array<long>, h long, node int, dist double"),
                  "topk-nodes")
    queries = save(vectors.where(F.col("id") % every == 0).select("id", "v", F.xxhash64("id", "v").alias("h"))
                   .mapInPandas(_nearest(mid), "id long, v array<double>, h long, node int, dist double"), "topk-queries")

    def nodes(df):                             # radius and rows of each node: at most ``centres`` rows
        radius, rows = np.full(n_nodes, -1.0), np.zeros(n_nodes, dtype=np.int64)
        for r in df.groupBy("node").agg(F.max("dist").alias("r"), F.count(F.lit(1)).alias("n")).collect():
            radius[r["node"]], rows[r["node"]] = r["r"], r["n"]
        return radius, rows
    rad_p, n_p = nodes(points)
    rad_q, n_q = nodes(queries)
    norm = np.sqrt((mid ** 2).sum(axis=1))
    high = (mid @ mid.T + rad_q[:, None] * norm[None, :] + rad_p[None, :] * norm[:, None] + rad_q[:, None] * rad_p[None, :])
    high = high + 1e-6 * (1 + np.abs(high))
    exists = (n_q[:, None] > 0) & (n_p[None, :] > 0)

    def blocks(df, rows):
        per = spark.createDataFrame([(i, max(1, -(-int(n) // block))) for i, n in enumerate(rows)], "node int, parts int")
        return df.join(F.broadcast(per), "node").withColumn("part", F.pmod("h", F.col("parts")).cast("int"))

    def meet(pairs: list[tuple[int, int]], floors: DataFrame | None) -> DataFrame:
        """Best of each query within the paired nodes."""
        plan = spark.createDataFrame([(a, b, max(1, -(-int(n_q[a]) // block)), max(1, -(-int(n_p[b]) // block)))
                                      for a, b in pairs], "qn int, pn int, qb int, pb int")
        # every block of a node meets every block of the other
        p = (blocks(points, n_p).withColumnRenamed("node", "pn").join(F.broadcast(plan.select("pn", "qn", "qb")), "pn")
             .withColumn("qpart", F.explode(F.sequence(F.lit(0), F.col("qb") - 1)))
             .select("qn", "qpart", "pn", F.col("part").alias("ppart"), "v", "ids"))
        q = blocks(queries, n_q).withColumnRenamed("node", "qn")
        q = q.join(floors, q["id"] == floors["query_id"], "left") if floors is not None else q.withColumn("floor", F.lit(None).cast("double"))
        q = (q.join(F.broadcast(plan.select("pn", "qn", "pb")), "qn")
             .withColumn("ppart", F.explode(F.sequence(F.lit(0), F.col("pb") - 1)))
             .select("qn", F.col("part").alias("qpart"), "pn", "ppart", "id", "v", "floor"))
        keys = ["qn", "qpart", "pn", "ppart"]

        def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
            qv, pv = np.stack(left["v"].to_numpy()), np.stack(right["v"].to_numpy())
            ids = np.full((len(right), k + 1), np.iinfo(np.int64).max)
            for i, own in enumerate(right["ids"]):
                ids[i, :len(own)] = own
            floor = left["floor"].fillna(-np.inf).to_numpy(dtype=float)
            best = Best(len(left), k, floor)
            own = left["id"].to_numpy(dtype=np.int64)
            walk(CoverTree(qv, np.arange(len(left))), CoverTree(pv, np.arange(len(right))), qv, own, pv, ids, best)
            out = pd.DataFrame({"query_id": np.repeat(own, k), "vec_id": best.ids.ravel(), "score": best.score.ravel()})
            return out[np.isfinite(out["score"]) & (out["score"] >= np.repeat(floor, k))]

        return q.groupBy(*keys).cogroup(p.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")

    def best_of(df):
        order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        return df.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = [(a, int(b)) for a in range(n_nodes) if n_q[a]
             for b in np.argsort(-np.where(exists[a], high[a], -np.inf), kind="stable")[:FIRST_NODES] if exists[a, b]]
    if not first:
        return spark.createDataFrame([], empty)
    found = save(best_of(meet(first, None)), "topk-first")
    # what a query still needs; a query with fewer than k hits has no floor
    floors = save(queries.select(F.col("id").alias("query_id"), "node").join(
        found.groupBy("query_id").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n")), "query_id", "left")
        .select("query_id", "node", F.when(F.col("n") == k, F.col("low").cast("double")).alias("floor")), "topk-floors")
    worst = np.full(n_nodes, -np.inf)
    for r in floors.groupBy("node").agg(F.min("floor").alias("w"), F.count_if(F.col("floor").isNull()).alias("open")).collect():
        worst[r["node"]] = -np.inf if r["open"] or r["w"] is None else r["w"]
    seen = set(first)
    rest = [(a, b) for a in range(n_nodes) for b in range(n_nodes)
            if exists[a, b] and (a, b) not in seen and high[a, b] >= worst[a]]
    every_hit = found.select("query_id", "vec_id", "score")
    if rest:
        every_hit = every_hit.unionByName(meet(rest, floors.select("query_id", "floor")))
    return best_of(every_hit).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
