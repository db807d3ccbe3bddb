"""Routing on hand-worked graphs (FIXTURES D4) and against a heap Dijkstra."""

import heapq
import random

import pytest
from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadcast.operators import graph as G

D4 = [("A", "B", 36.0), ("B", "C", 10.0), ("A", "C", 50.0), ("C", "D", 5.0), ("E", "A", 1.0)]


def edges_df(spark, rows, scen=None):
    if scen is None:
        return spark.createDataFrame(rows, "src string, dst string, cost double")
    return spark.createDataFrame([(scen, *r) for r in rows], "scen string, src string, dst string, cost double")


def routes(spark, rows, pairs, vertices="both", **kw):
    e = edges_df(spark, rows)
    p = spark.createDataFrame(pairs, "src string, dst string")
    out = G.route(e, p, vertices=vertices, **kw).collect()
    return {(r.src, r.dst): (r.status, r.total, r.path) for r in out}


def test_d4_statuses(spark):
    res = routes(spark, D4, [("A", "C"), ("A", "D"), ("A", "A"), ("A", "E"), ("A", "Z"), ("Z", "A")])
    assert res[("A", "C")] == ("ok", 46.0, ["A", "B", "C"])
    assert res[("A", "D")] == ("ok", 51.0, ["A", "B", "C", "D"])
    assert res[("A", "A")] == ("ok", 0.0, ["A"])
    assert res[("A", "E")] == ("unreachable", None, None)
    assert res[("A", "Z")] == ("dst_missing", None, None)
    assert res[("Z", "A")] == ("src_missing", None, None)


def test_d4_sink_only_is_missing_with_src_vertices(spark):
    res = routes(spark, D4, [("A", "D"), ("A", "C")], vertices="src")
    assert res[("A", "D")][0] == "dst_missing"
    assert res[("A", "C")] == ("ok", 46.0, ["A", "B", "C"])


def test_d4_ties_take_smaller_path_and_parallel_edges(spark):
    rows = D4 + [("A", "X", 23.0), ("X", "C", 23.0), ("A", "B", 40.0)]
    res = routes(spark, rows, [("A", "C"), ("A", "D")])
    assert res[("A", "C")] == ("ok", 46.0, ["A", "B", "C"])
    assert res[("A", "D")] == ("ok", 51.0, ["A", "B", "C", "D"])


def test_negative_cost_rejected(spark):
    with pytest.raises(ValueError):
        routes(spark, D4 + [("B", "A", -1.0)], [("A", "C")])


def test_zero_and_null_costs(spark):
    # zero-cost cycle A <-> B, zero-cost last step M -> T with the smaller path, null edge N -> T
    rows = [("A", "B", 0.0), ("B", "A", 0.0), ("A", "T", 6.0), ("A", "M", 6.0), ("M", "T", 0.0), ("A", "N", 1.0), ("N", "T", None)]
    res = routes(spark, rows, [("A", "T"), ("B", "T"), ("A", "B"), ("A", "N")])
    assert res == {("A", "T"): ("ok", 6.0, ["A", "M", "T"]),
                   ("B", "T"): ("ok", 6.0, ["B", "A", "M", "T"]),
                   ("A", "B"): ("ok", 0.0, ["A", "B"]), ("A", "N"): ("ok", 1.0, ["A", "N"])}


def test_hub_chunking_gives_same_answer(spark):
    # star: hub H -> 60 leaves, leaves -> T with varying costs
    rows = [("S", "H", 1.0)] + [("H", f"L{i:02d}", float(1 + i % 7)) for i in range(60)]
    rows += [(f"L{i:02d}", "T", float(1 + (i * 13) % 11)) for i in range(60)]
    e = edges_df(spark, rows)
    src = spark.createDataFrame([("S",)], "source string")
    plain = {r.id: (r.dist, r.path) for r in G.shortest_paths(e, src).collect()}
    chunked = {r.id: (r.dist, r.path) for r in G.shortest_paths(e, src, fanout_chunk=4).collect()}
    assert plain == chunked
    assert plain["T"][0] == min(1 + (1 + i % 7) + (1 + (i * 13) % 11) for i in range(60))


def test_scenarios_route_together(spark):
    rows = [("x", *r) for r in D4] + [("y", "A", "C", 1.0), ("y", "C", "D", 1.0)]
    e = spark.createDataFrame(rows, "scen string, src string, dst string, cost double")
    p = spark.createDataFrame([("x", "A", "D"), ("y", "A", "D"), ("y", "A", "B")],
                              "scen string, src string, dst string")
    out = {(r.scen, r.dst): (r.status, r.total) for r in G.route(e, p, ["scen"]).collect()}
    assert out[("x", "D")] == ("ok", 51.0)
    assert out[("y", "D")] == ("ok", 2.0)
    assert out[("y", "B")] == ("dst_missing", None)


def dijkstra(rows, source):
    adj = {}
    for s, d, c in rows:
        adj.setdefault(s, {})
        adj[s][d] = min(c, adj[s].get(d, c))
    best = {source: (0, (source,))}
    heap = [(0, (source,))]
    while heap:
        d, path = heapq.heappop(heap)
        u = path[-1]
        if best.get(u) != (d, path):
            continue
        for v, c in adj.get(u, {}).items():
            cand = (d + c, path + (v,))
            if v not in best or cand < best[v]:
                best[v] = cand
                heapq.heappush(heap, cand)
    return best


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(min_value=0, max_value=10_000))
def test_matches_heap_dijkstra(spark, seed):
    rnd = random.Random(seed)
    n = rnd.randint(2, 12)
    rows = [(rnd.randrange(n), rnd.randrange(n), rnd.randint(1, 9)) for _ in range(rnd.randint(1, 40))]
    e = spark.createDataFrame(rows, "src long, dst long, cost long")
    src = spark.createDataFrame([(0,)], "source long")
    got = {r.id: (r.dist, tuple(r.path)) for r in G.shortest_paths(e, src).collect()}
    assert got == dijkstra(rows, 0)
    # triangle inequality over every edge
    for s, d, c in rows:
        if s in got:
            assert got[d][0] <= got[s][0] + c


def test_aggregate_messages_and_triplets(spark):
    v = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "id string, w int")
    e = edges_df(spark, [("A", "B", 1.0), ("B", "C", 2.0), ("A", "C", 5.0), ("C", "Z", 1.0)])
    t = G.triplets(v, e)
    assert t.count() == 3  # the edge into Z (not a vertex) is dropped
    m = {r.id: r.msg for r in G.aggregate_messages(v, e, F.min, to_dst=F.col("cost") + F.col("src_w")).collect()}
    assert m == {"B": 2.0, "C": 4.0}


def test_result_does_not_depend_on_widths(spark):
    from roadcast.plans import graph_checks as GC

    edges = GC.directed_edges(spark, "/root/testdata/sf0.001")
    srcs = GC._sources(edges)
    results = []
    for widths in ({}, {"fanout_chunk": 3}, {"partitions": 2}, {"edges_per_partition": 100}):
        sp = G.shortest_paths(edges, srcs, ["scen"], **widths)
        results.append(sorted((r.scen, r.id, r.dist, tuple(r.path)) for r in sp.collect()))
    assert results[0] == results[1] == results[2] == results[3]


def test_empty_graph_and_requests(spark):
    e = spark.createDataFrame([], "src string, dst string, cost double")
    p = spark.createDataFrame([("A", "B")], "src string, dst string")
    out = [(r.status, r.total) for r in G.route(e, p).collect()]
    assert out == [("dst_missing", None)]
    none = spark.createDataFrame([], "src string, dst string")
    assert G.route(edges_df(spark, D4), none).count() == 0


def parent_rule(rows, source):
    """Least costs, then the smallest predecessor among those achieving them."""
    best = dijkstra(rows, source)
    dist = {v: d for v, (d, _) in best.items()}
    cost = {}
    for s, d, c in rows:
        cost[(s, d)] = min(c, cost.get((s, d), c))
    parent = {}
    for (u, v), c in cost.items():
        if u in dist and v in dist and v != source and dist[u] + c == dist[v]:
            parent[v] = min(u, parent.get(v, u))
    paths = {}
    for v in dist:
        p, cur = [v], v
        while cur != source:
            cur = parent[cur]
            p.insert(0, cur)
        paths[v] = (dist[v], tuple(p))
    return paths


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(min_value=0, max_value=10_000))
def test_parent_mode_matches_rule(spark, seed):
    rnd = random.Random(seed)
    n = rnd.randint(2, 10)
    rows = [(rnd.randrange(n), rnd.randrange(n), rnd.randint(1, 4)) for _ in range(rnd.randint(1, 35))]
    e = spark.createDataFrame(rows, "src long, dst long, cost long")
    verts = {s for s, _, _ in rows} | {d for _, d, _ in rows}
    want = parent_rule(rows, 0) if 0 in verts else {}      # else every request is src_missing
    pairs = spark.createDataFrame([(0, v) for v in range(n)], "src long, dst long")
    got = {r.dst: (r.total, tuple(r.path)) for r in G.route(e, pairs, path_mode="parent").collect()
           if r.status == "ok"}
    assert got == {v: want[v] for v in want if v in got} and set(got) == set(want) & set(range(n))


def test_parent_mode_source_without_edges(spark):
    e = spark.createDataFrame([(1, 2, 3)], "src long, dst long, cost long")
    pairs = spark.createDataFrame([(0, 2), (1, 2)], "src long, dst long")
    got = {(r.src, r.dst): (r.status, r.total, r.path) for r in G.route(e, pairs, path_mode="parent").collect()}
    assert got == {(0, 2): ("src_missing", None, None), (1, 2): ("ok", 3, [1, 2])}


def test_null_costs_and_ends_are_no_edges(spark):
    edges = spark.createDataFrame([("A", "B", 1.0), ("B", "T", None), ("A", "C", 2.0), ("C", "T", 4.0), (None, "T", 1.0)],
                                  "src string, dst string, cost double")
    pairs = spark.createDataFrame([("A", "T")], "src string, dst string")
    assert [(r.status, r.total, r.path) for r in G.route(edges, pairs).collect()] == [("ok", 6.0, ["A", "C", "T"])]


def test_result_does_not_depend_on_the_number_of_targets(spark):
    edges = spark.createDataFrame([(i, i + 1, 1.0) for i in range(8)], "src long, dst long, cost double")
    src = spark.createDataFrame([(0,)], "source long")
    for n in (1, 5):
        targets = spark.createDataFrame([(0, 2 + k) for k in range(n)], "source long, target long")
        got = G.shortest_paths(edges, src, targets=targets).collect()
        assert sorted((r["id"], r["dist"]) for r in got) == [(2 + k, 2.0 + k) for k in range(n)]


def flat_rule(rows, source):
    """Least cost, then fewest edges since it last grew, then the smallest predecessor."""
    best = {source: (0, 0)}
    for _ in range(len(rows) + 1):
        for u, v, c in rows:
            if u in best:
                d, flat = best[u]
                best[v] = min(best.get(v, (1 << 60, 0)), (d + c, flat + 1 if c == 0 else 0))
    parent = {}
    for u, v, c in rows:
        if u in best and v != source and (best[u][0] + c, best[u][1] + 1 if c == 0 else 0) == best[v]:
            parent[v] = min(u, parent.get(v, u))
    return best, parent


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(min_value=0, max_value=10_000))
def test_parent_mode_with_zero_costs(spark, seed):
    rnd = random.Random(seed)
    n = rnd.randint(3, 9)
    rows = [(rnd.randrange(n), rnd.randrange(n), rnd.choice([0, 0, 1, 2])) for _ in range(rnd.randint(4, 35))] + [(0, 1, 0), (1, 0, 0)]
    best, parent = flat_rule(rows, 0)
    e = spark.createDataFrame(rows, "src long, dst long, cost long")
    tree = G.shortest_paths(e, spark.createDataFrame([(0,)], "source long"), path_mode="parent")
    assert {r.id: (r.dist, r.parent) for r in tree.collect()} == {v: (best[v][0], parent.get(v)) for v in best}
    asked = spark.createDataFrame([(0, v) for v in range(n)], "source long, target long")
    for r in G.trace_paths(tree, asked).collect():
        want, cur = [r.target], r.target
        while cur in parent:
            cur = parent[cur]
            want.insert(0, cur)
        assert r.path == want and r.hops == len(want) - 1


def test_parent_mode_returns_final_rows_only(spark):
    rows = [("A", "T", 1.0), ("A", "B", 10.0), ("A", "D", 1.0), ("D", "E", 1.0), ("E", "F", 1.0), ("F", "B", 1.0)]
    src, targets = spark.createDataFrame([("A",)], "source string"), spark.createDataFrame([("A", "T")], "source string, target string")
    got = {r.id: (r.dist, r.parent) for r in G.shortest_paths(edges_df(spark, rows), src, targets=targets, path_mode="parent").collect()}
    assert got["T"] == (1.0, "A") and "B" not in got
    assert all(got[v][0] == d for v, (d, _) in dijkstra(rows, "A").items() if v in got)


def test_trace_of_long_paths(spark):
    e = spark.createDataFrame([(i, i + 1, 1) for i in range(21)], "src long, dst long, cost long")
    tree = G.shortest_paths(e, spark.createDataFrame([(0,)], "source long"), path_mode="parent")
    asked = spark.createDataFrame([(0, 0), (0, 1), (0, 13), (0, 21), (0, 99)], "source long, target long")
    assert {r.target: r.path for r in G.trace_paths(tree, asked).collect()} == {t: list(range(t + 1)) for t in (0, 1, 13, 21)}
    with pytest.raises(RuntimeError):
        G.trace_paths(tree, asked, max_hops=20)


def test_log_is_merged_and_holds_improvements_only(spark):
    e = spark.createDataFrame([(i, i + 1, 1) for i in range(24)] + [(0, i, 3 * i) for i in range(2, 25)], "src long, dst long, cost long")
    stats = {}
    sp = G.shortest_paths(e, spark.createDataFrame([(0,)], "source long"), stats=stats)
    assert {r.id: (r.dist, r.hops) for r in sp.collect()} == {i: (i, i) for i in range(25)}
    assert stats["compactions"] >= 1 and stats["written"] <= 2 * sum(stats["frontier"])
    few = {}
    G.shortest_paths(e, spark.createDataFrame([(20,)], "source long"), stats=few)
    assert few["compactions"] == 0 and few["written"] == sum(few["frontier"])


def grid(n, rnd):
    """n x n streets in both directions, costs between 1 and 2."""
    rows = []
    for x in range(n):
        for y in range(n):
            for a, b in ((x + 1, y), (x, y + 1)):
                if a < n and b < n:
                    rows += [(x * n + y, a * n + b, 1 + rnd.random()), (a * n + b, x * n + y, 1 + rnd.random())]
    return rows


@pytest.mark.parametrize("mode", ["array", "parent"])
def test_landmarks_cut_the_search_and_change_nothing(spark, mode):
    rows = grid(9, random.Random(3)) + [(200, 201, 1.0), (201, 0, 1.0)]
    e = spark.createDataFrame(rows, "src long, dst long, cost double")
    pairs = spark.createDataFrame([(0, 12), (0, 3), (40, 44), (80, 79), (200, 5), (7, 7)], "src long, dst long")
    marks = G.landmark_table(e, n=3)
    plain, led = {}, {}
    want = sorted((r.src, r.dst, r.status, r.total, r.path) for r in G.route(e, pairs, stats=plain, path_mode=mode).collect())
    got = sorted((r.src, r.dst, r.status, r.total, r.path) for r in G.route(e, pairs, stats=led, path_mode=mode, landmarks=marks).collect())
    assert got == want
    assert {(s, d): p for s, d, _, _, p in got}[0, 12] == list(dijkstra(rows, 0)[12][1])
    assert sum(led["frontier"]) < 0.8 * sum(plain["frontier"])
