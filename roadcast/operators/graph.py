"""Graph building, message passing and least-cost routing (G1-G8).

A graph is two DataFrames that may hold many graphs at once, told apart by
*scenario columns* (for example ``condition`` and ``hour``):

* edges    : <scenario cols>, src, dst, cost
* vertices : <scenario cols>, id

Least-cost routing is a set-based frontier relaxation (Bellman-Ford with a
frontier, the Pregel model): every round, all vertices whose (dist, path)
improved in the previous round -- of all scenarios and all sources at once --
send ``dist + cost`` along their out-edges, the candidates are reduced with a
partial+final ``min`` per target, and those that beat all that is known are
appended to a log.  The number of rounds is the hop count of the longest
least-cost path plus one, instead of one round per settled vertex.

Scale notes
-----------
* Parallel edges are collapsed to their minimum cost first (same answer).
* Hot vertices: a vertex may own a large share of all edges.  Its adjacency
  list is split into ``ceil(out_degree / fanout_chunk)`` hash chunks; a
  frontier row is replicated once per chunk of its vertex and joined on
  (scenario, src, chunk), so no single task expands a whole hub.  Only vertices
  with more than one chunk are looked up, by a join of their own short table.
* Candidates are pre-aggregated map-side (``min`` is partial) before the
  shuffle on (scenario, source, target); one anti-join against the log on the
  same keys drops those that are no improvement.
* A round writes the improved rows and nothing else: they are the next frontier
  and the newest part of the log (Parquet under ``spark.checkpoint.dir``, counted
  by an ``Observation`` on that write).  The log holds at
  least as good a row for every earlier one of a key, so it needs no update; once
  ``LOG_PARTS`` newest parts are of like size they are merged to one row per key,
  so a row is rewritten a logarithmic number of times.
* The log and the targets are bucketed tables on (scenario, source, vertex), with
  as many buckets as a shuffle has partitions: a round shuffles its candidates
  and nothing of what is known -- neither to compare them, nor for the bounds,
  nor to merge parts.  Shuffle files of a round go when it is written.
* Edges are collapsed once (the edge source is read once), gathered to adjacency
  lists (a round reads a row per vertex and chunk, not per edge), then checkpointed
  hash-partitioned and sorted on the join keys (scenario, src, chunk) by a
  session without adaptive execution, so the partitioning is recorded: no round
  re-shuffles or re-sorts them, only the frontier moves.  They are also
  persisted in columnar form; lost blocks come back from the checkpoint.
* No size switches anything: every graph takes the same joins and the same store.
* A lost executor never replays earlier rounds; ``localCheckpoint`` is not used.

Goal direction
--------------
With targets, the search of a source is cut as soon as it has reached all of
them: with u(t) the best distance known to a target and i(t) the cheapest edge
into it, vertices beyond ``max(u(t) - i(t))`` are not expanded -- no path over
them ends at a target in time -- and candidates beyond ``max(u(t))`` are dropped
before the shuffle.  Both bounds shrink as targets improve.  Rows are compared with
the targets only once as many are known as some source has targets.  ``landmarks`` adds
lower bounds from distances to and from a few fixed vertices
(``landmark_table``), which cut vertices that lie the wrong way, and upper bounds
that hold from the first round on.

Ties are broken by the smallest path (lexicographic on the vertex list), which
gives one well-defined answer.  Costs must not be negative; a cycle of zero cost
never improves a path, since a path sorts before its own extensions.  Parent
pointers take the smallest predecessor among those that achieve the least
distance with the fewest edges since the distance last grew; along edges of no
cost that count falls from child to parent, so pointers never form a cycle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from contextlib import contextmanager
import time

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir, scratch_path, write_read as _write_read

STATUS_OK = "ok"
STATUS_SRC_MISSING = "src_missing"
STATUS_DST_MISSING = "dst_missing"
STATUS_UNREACHABLE = "unreachable"


def _cols(scenario_cols: Iterable[str] | None) -> list[str]:
    return list(scenario_cols or [])


# --------------------------------------------------------------------------
# G1: build a graph from per-link costs
# --------------------------------------------------------------------------
def build_graph(costs: DataFrame, scenario_cols: Sequence[str] = (), src: str = "from_node",
                dst: str = "to_node", cost: str = "travel_s",
                vertices: str = "both") -> tuple[DataFrame, DataFrame]:
    """Edges (src, dst, cost) and vertices (id) from a per-link cost table.

    Parallel links stay separate edges.  ``vertices="both"`` takes ids from
    both ends; ``vertices="src"`` keeps only ids that start an edge (so a pure
    sink is not a vertex), as the reference does.
    """
    scen = _cols(scenario_cols)
    edges = costs.select(*scen, F.col(src).alias("src"), F.col(dst).alias("dst"),
                         F.col(cost).alias("cost"))
    return edges, graph_vertices(edges, scen, vertices)


def graph_vertices(edges: DataFrame, scenario_cols: Sequence[str] = (),
                   vertices: str = "both") -> DataFrame:
    scen = _cols(scenario_cols)
    out = edges.select(*scen, F.col("src").alias("id"))
    if vertices == "both":
        out = out.unionByName(edges.select(*scen, F.col("dst").alias("id")))
    elif vertices != "src":
        raise ValueError(f"vertices must be 'both' or 'src', got {vertices!r}")
    return out.distinct()


# --------------------------------------------------------------------------
# J4 / G2: triplets and message aggregation
# --------------------------------------------------------------------------
def triplets(vertices: DataFrame, edges: DataFrame,
             scenario_cols: Sequence[str] = ()) -> DataFrame:
    """Edge rows with the attributes of both end vertices (``src_*``, ``dst_*``).

    Edges whose ends are not vertices are dropped (two inner equi-joins).
    """
    scen = _cols(scenario_cols)
    attrs = [c for c in vertices.columns if c not in scen and c != "id"]
    vs = vertices.select(*scen, F.col("id").alias("src"),
                         *[F.col(a).alias(f"src_{a}") for a in attrs])
    vd = vertices.select(*scen, F.col("id").alias("dst"),
                         *[F.col(a).alias(f"dst_{a}") for a in attrs])
    return edges.join(vs, [*scen, "src"]).join(vd, [*scen, "dst"])


def aggregate_messages(vertices: DataFrame, edges: DataFrame, agg=F.min,
                       to_dst: Column | None = None, to_src: Column | None = None,
                       scenario_cols: Sequence[str] = ()) -> DataFrame:
    """Send a message along every triplet and reduce per receiving vertex.

    ``to_dst`` / ``to_src`` are Column expressions over the triplet columns
    (edge columns, ``src_<attr>``, ``dst_<attr>``, ``src``, ``dst``).  Null
    messages are not sent.  Result: <scenario cols>, id, msg.
    """
    if to_dst is None and to_src is None:
        raise ValueError("give to_dst and/or to_src")
    scen = _cols(scenario_cols)
    t = triplets(vertices, edges, scen)
    sent = []
    if to_dst is not None:
        sent.append(t.select(*scen, F.col("dst").alias("id"), to_dst.alias("msg")))
    if to_src is not None:
        sent.append(t.select(*scen, F.col("src").alias("id"), to_src.alias("msg")))
    msgs = sent[0] if len(sent) == 1 else sent[0].unionByName(sent[1])
    return (msgs.where(F.col("msg").isNotNull())
            .groupBy(*scen, "id").agg(agg("msg").alias("msg")))


# --------------------------------------------------------------------------
# Routing state
# --------------------------------------------------------------------------
def collapse_edges(edges: DataFrame, scenario_cols: Sequence[str] = ()) -> DataFrame:
    """One edge per (scenario, src, dst) with the minimum cost (same routes).

    Edges without a cost or an end are no edges.
    """
    return _usable(edges).groupBy(*_cols(scenario_cols), "src", "dst").agg(F.min("cost").alias("cost"))


def _usable(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull() & F.col("cost").isNotNull())


def _chunks(degrees: DataFrame, fanout_chunk: int) -> DataFrame:
    """<scen>, src, chunks of the vertices whose adjacency list is split."""
    return (degrees.where(F.col("deg") > fanout_chunk)
            .withColumn("chunks", F.ceil(F.col("deg") / F.lit(fanout_chunk)).cast("int")).drop("deg"))


def out_degrees(edges: DataFrame, scenario_cols: Sequence[str] = ()) -> DataFrame:
    """<scen>, src, deg of collapsed edges."""
    return edges.groupBy(*_cols(scenario_cols), "src").agg(F.count(F.lit(1)).alias("deg"))


def vertex_table(edges: DataFrame, scenario_cols: Sequence[str] = ()) -> DataFrame:
    """<scen>, id, deg (edges out of it), least_in (its cheapest edge in, null without one)
    of collapsed edges: both ends in one aggregate."""
    scen, none = _cols(scenario_cols), F.lit(None).cast(edges.schema["cost"].dataType)
    ends = (edges.select(*scen, F.col("src").alias("id"), F.lit(1).alias("out"), none.alias("cost"))
            .unionByName(edges.select(*scen, F.col("dst").alias("id"), F.lit(0).alias("out"), "cost")))
    return ends.groupBy(*scen, "id").agg(F.sum("out").alias("deg"), F.min("cost").alias("least_in"))


def prepare_edges(edges: DataFrame, scenario_cols: Sequence[str] = (),
                  fanout_chunk: int = 50_000, collapsed: bool = False,
                  hubs: DataFrame | None = None, landmarks: DataFrame | None = None,
                  partitions: int | None = None) -> DataFrame:
    """Collapse parallel edges to their minimum and gather them to adjacency lists.

    Output: <scen>, src, chunk, dst, cost, dst_chunks[, to_mark, from_mark], one
    row per (scenario, src, chunk).  ``chunk`` is a hash bucket of the edge inside
    the adjacency list of ``src`` (one bucket unless the out-degree exceeds
    ``fanout_chunk``).  ``dst``, ``cost`` and ``dst_chunks`` are arrays with an
    entry per edge: its target, its cost and the number of buckets of the target
    (null where all targets of the row have one).
    ``hubs`` (<scen>, src, chunks): the split vertices, if known already.
    ``landmarks``: a ``landmark_table``; its distances are those of ``src``.
    ``partitions``: number of partitions the rows are hashed to by their key.
    """
    scen = _cols(scenario_cols)
    keys = [*scen, "src", "chunk"]
    e = edges if collapsed else collapse_edges(edges, scen)
    hubs = _chunks(out_degrees(e, scen), fanout_chunk) if hubs is None else hubs
    dst_hubs = hubs.select(*scen, F.col("src").alias("dst"), F.col("chunks").alias("dst_chunks"))
    flat = (e.join(hubs, [*scen, "src"], "left")
            .join(dst_hubs, [*scen, "dst"], "left")
            .select(*scen, "src",
                    F.coalesce(F.pmod(F.xxhash64("dst"), F.col("chunks")), F.lit(0)).cast("int").alias("chunk"),
                    F.struct("dst", "cost", F.coalesce(F.col("dst_chunks"), F.lit(1)).alias("chunks")).alias("edge")))
    marks = []
    if landmarks is not None:       # rows of their own, one per list: they meet the edges in the same shuffle
        marks = [F.first(c, ignorenulls=True).alias(c) for c in _LANDMARK]
        of_src = landmarks.withColumnRenamed("id", "src").join(hubs, [*scen, "src"], "left")
        flat = flat.unionByName(of_src.select(
            *scen, "src", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("chunks"), F.lit(1)) - 1)).alias("chunk"), *_LANDMARK),
            allowMissingColumns=True)
    if partitions is not None:
        flat = flat.repartition(partitions, *keys)
    lists = flat.groupBy(*keys).agg(F.collect_list("edge").alias("out"), *marks)
    return lists.select(*keys, F.col("out.dst").alias("dst"), F.col("out.cost").alias("cost"),
                        F.when(F.exists("out", lambda x: x["chunks"] > 1), F.col("out.chunks")).alias("dst_chunks"),
                        *[c for c in _LANDMARK if marks])


def _rank(d: Column, p: Column) -> Column:
    """(dist, path): the path breaks ties."""
    return F.struct(d.alias("d"), p.alias("p"))


PATH_MODES = ("array", "parent", "none")


def _path_mode(with_path: bool, path_mode: str | None) -> str:
    mode = path_mode or ("array" if with_path else "none")
    if mode not in PATH_MODES:
        raise ValueError(f"path_mode must be one of {PATH_MODES}, got {mode!r}")
    return mode


_LANDMARK = ("to_mark", "from_mark")


def _path_type(mode: str, id_type: T.DataType) -> T.DataType:
    if mode == "parent":        # flat: edges since the distance last grew
        return T.StructType([T.StructField("flat", T.IntegerType()), T.StructField("parent", id_type)])
    return T.ArrayType(id_type, containsNull=True)


def seed_state(prepared: DataFrame, sources: DataFrame, scenario_cols: Sequence[str] = (),
               with_path: bool = True, path_mode: str | None = None, hubs: DataFrame | None = None) -> DataFrame:
    """Initial state: every (scenario, source) at distance 0, marked changed.

    ``sources``: <scen>, source.  Sources without out-edges still get a row
    (they reach only themselves).  The ``path`` column holds the tie-breaker
    of the chosen ``path_mode``: the vertex list (``array``), the predecessor
    (``parent``; null at the source) or nothing (``none``).
    """
    scen = _cols(scenario_cols)
    mode = _path_mode(with_path, path_mode)
    id_type = prepared.schema["src"].dataType
    if mode == "parent":
        path_col = F.struct(F.lit(0).alias("flat"), F.lit(None).alias("parent"))
    else:
        path_col = F.array(F.col("source")) if mode == "array" else F.lit(None)
    seeds = sources.select(*scen, "source").distinct()
    if hubs is None:        # chunk count of a source = max(chunk)+1 over its out-edges
        hubs = prepared.groupBy(*scen, "src").agg((F.max("chunk") + 1).alias("chunks"))
    seeds = seeds.join(hubs.withColumnRenamed("src", "source"), [*scen, "source"], "left")
    return seeds.select(*scen, "source", F.col("source").alias("id"),
                        F.lit(0).cast(prepared.schema["cost"].dataType.elementType).alias("dist"),
                        path_col.cast(_path_type(mode, id_type)).alias("path"),
                        F.coalesce(F.col("chunks"), F.lit(1)).alias("chunks"),
                        F.lit(True).alias("changed"))


def _on(left: str, right: str, cols: Iterable[str]) -> str:
    return " AND ".join(f"{left}.`{c}` = {right}.`{c}`" for c in cols)


def _list(table: str, cols: Iterable[str]) -> str:
    return ", ".join(f"{table}.`{c}`" for c in cols)


def _candidates(frontier: DataFrame, prepared: DataFrame, scen: list[str], mode: str,
                bound: DataFrame | None, known: DataFrame | None = None) -> DataFrame:
    """Best candidate (new_d, new_p, new_c) per (scenario, source, id) one edge on;
    given ``known`` rows, only those that beat every known row of their key.

    ``bound``: <scen>, source, expand, stop[, over_to, over_from]; a source
    without a row is not bounded.  One SQL text: a round is planned in one pass.
    """
    led = bound is not None and "over_to" in bound.columns
    d = f"CAST(y.dist + get(y.cost, y.at) AS {prepared.schema['cost'].dataType.elementType.simpleString()})"
    p = {"array": "concat(y.path, array(y.dst))", "none": "NULL",
         "parent": f"struct(CASE WHEN {d} = y.dist THEN y.path.flat + 1 ELSE 0 END AS flat, y.id AS parent)"}[mode]
    rank, old = ((d, "k.dist") if mode == "none" else           # numbers only: a hash aggregate, no sort
                 (f"struct({d} AS d, {p} AS p)", "struct(k.dist AS d, k.path AS p)"))
    limits = "NULL AS stop" if bound is None else _list("b", ["expand", "stop", *(["over_to", "over_from"] if led else [])])
    path = frontier.schema["path"].dataType.simpleString()
    best = f"""
        SELECT {_list('y', [*scen, 'source'])}, y.dst AS id, min({rank}) AS m, min(coalesce(get(y.dst_chunks, y.at), 1)) AS new_c
        FROM (SELECT x.*, e.cost, e.dst_chunks, posexplode(e.dst) AS (at, dst)
              FROM (SELECT {_list('f', [*scen, 'source', 'id', 'dist', 'path'])}, {limits},
                           explode(sequence(0, f.chunks - 1)) AS chunk
                    FROM {{frontier}} f
                    {f"LEFT JOIN {{bound}} b ON {_on('b', 'f', [*scen, 'source'])} WHERE b.stop IS NULL OR f.dist <= b.expand" if bound is not None else ''}) x
              JOIN {{prepared}} e ON {_on('e', 'x', [*scen, 'chunk'])} AND e.src = x.id
              {f"WHERE x.stop IS NULL OR {_on_the_way('x.dist', 'e', 'x')}" if led else ''}) y
        {f'WHERE y.stop IS NULL OR {d} <= y.stop' if bound is not None else ''}
        GROUP BY {_list('y', [*scen, 'source'])}, y.dst"""
    new = f"m AS new_d, CAST(NULL AS {path}) AS new_p" if mode == "none" else "m.d AS new_d, m.p AS new_p"
    keys = [*scen, "source", "id"]
    sql = (f"SELECT {_list('n', keys)}, {new}, new_c FROM ({best}) n"
           + (f" LEFT ANTI JOIN {{known}} k ON {_on('k', 'n', keys)} AND {old} <= n.m" if known is not None else ""))
    tables = {"frontier": frontier, "prepared": prepared, "bound": bound, "known": known}
    return frontier.sparkSession.sql(sql, **{k: v for k, v in tables.items() if v is not None})


def relax(state: DataFrame, prepared: DataFrame, scenario_cols: Sequence[str] = (),
          with_path: bool = True, bound: DataFrame | None = None,
          path_mode: str | None = None, frontier: DataFrame | None = None) -> DataFrame:
    """One round: changed vertices send dist+cost; accept strictly smaller.

    Returns the full new state with ``changed`` marking improved rows -- or,
    when the ``frontier`` is given, the improved rows only, compared with a
    ``state`` that may hold several rows of a key.
    ``bound`` (<scen>, source, expand, stop) prunes frontier rows beyond ``expand``
    and candidates beyond ``stop``.  In ``parent`` mode ties go to the
    smallest predecessor instead of the smallest path.
    """
    scen = _cols(scenario_cols)
    mode = _path_mode(with_path, path_mode)
    keys = [*scen, "source", "id"]
    if frontier is not None:
        return _candidates(frontier, prepared, scen, mode, bound, state).withColumnsRenamed(
            {"new_d": "dist", "new_p": "path", "new_c": "chunks"})
    best = _candidates(state.where(F.col("changed")).drop("changed"), prepared, scen, mode, bound)
    merged = state.drop("changed").join(best, keys, "full_outer")
    improved = (F.col("new_d").isNotNull() & (F.col("dist").isNull() | (
        _rank(F.col("new_d"), F.col("new_p")) < _rank(F.col("dist"), F.col("path")))))
    return merged.select(
        *keys,
        F.when(improved, F.col("new_d")).otherwise(F.col("dist")).alias("dist"),
        F.when(improved, F.col("new_p")).otherwise(F.col("path")).alias("path"),
        F.coalesce(F.col("chunks"), F.col("new_c")).alias("chunks"),
        F.coalesce(improved, F.lit(False)).alias("changed"))


# --------------------------------------------------------------------------
# Goal direction
# --------------------------------------------------------------------------
def _goals(known: DataFrame, targets: DataFrame, scen: list[str], marks: DataFrame | None) -> DataFrame:
    """<scen>, source, id, least_in (cheapest edge into the target), n_targets of the
    source[, goal_to, goal_from, reach (shortest way known over a landmark)].
    ``known``: a ``vertex_table``."""
    kind, least = known.schema["least_in"].dataType, known.select(*scen, "id", "least_in")
    each = targets.groupBy(*scen, "source").agg(F.count(F.lit(1)).alias("n_targets"))
    goals = (targets.withColumnRenamed("target", "id").join(least, [*scen, "id"], "left").join(each, [*scen, "source"])
             .select(*scen, "source", "id", F.coalesce("least_in", F.lit(0).cast(kind)).alias("least_in"), "n_targets"))
    if marks is None:
        return goals
    at_goal = marks.select(*scen, "id", F.col("to_mark").alias("goal_to"), F.col("from_mark").alias("goal_from"))
    at_source = marks.select(*scen, F.col("id").alias("source"), F.col("to_mark").alias("source_to"))
    over = F.array_min(F.zip_with("source_to", "goal_from", lambda a, b: a + b))     # null where no landmark joins them
    return (goals.join(at_goal, [*scen, "id"], "left").join(at_source, [*scen, "source"], "left")
            .withColumn("reach", F.when(F.col("id") == F.col("source"), F.lit(0)).otherwise(over).cast(kind)).drop("source_to"))


def _hits(rows: DataFrame, goals: DataFrame, scen: list[str]) -> DataFrame:
    """The rows that are targets, with what ``_bound`` needs of them and no path."""
    by = [*scen, "source", "id"]
    return (rows.select(*by, "dist").join(goals.select(*by, "least_in", "n_targets"), by)
            .select(*by, "dist", F.lit(None).cast("int").alias("path"), "least_in", "n_targets"))


def _bound(hits: DataFrame, scen: list[str], goals: DataFrame | None = None, n_marks: int = 0) -> DataFrame:
    """Per source that has an upper bound u(t) for all its targets: ``stop`` =
    max(u(t)), ``expand`` = max(u(t) - i(t)) and, per landmark L, ``over_to`` =
    max(u(t) + d(t, L)) and ``over_from`` = max(u(t) - d(L, t)), null where a
    target has no such distance.  ``hits``: rows of targets, see ``_hits``.

    Sums of fractional costs get what rounding may have taken from them.
    """
    share = {"double": 1e-9, "float": 1e-4}.get(hits.schema["dist"].dataType.simpleString())
    near = lambda x, *terms: f"max({x}" + (f" + {share}D * ({' + '.join(f'abs({t})' for t in terms)}))" if share else ")")
    by = [*scen, "source"]
    best = (f"SELECT {_list('l', [*by, 'id', 'least_in', 'n_targets'])}, min(l.dist) AS u FROM {{hits}} l "
            f"GROUP BY {_list('l', [*by, 'id', 'least_in', 'n_targets'])}")
    over, tables = "", {"hits": hits}
    if n_marks:
        best = (f"SELECT * FROM (SELECT g.* EXCEPT (reach), least(h.u, g.reach) AS u FROM {{goals}} g "
                f"LEFT JOIN ({best}) h ON {_on('g', 'h', [*by, 'id'])}) WHERE u IS NOT NULL")
        tables["goals"] = goals
        for name, goal, sign in (("over_to", "goal_to", "+"), ("over_from", "goal_from", "-")):
            cells = [f"CASE WHEN count_if(get({goal}, {k}) IS NULL) = 0 THEN {near(f'u {sign} get({goal}, {k})', 'u', f'get({goal}, {k})')} END"
                     for k in range(n_marks)]
            over += f", array({', '.join(cells)}) AS {name}"
    return hits.sparkSession.sql(
        f"SELECT {_list('t', by)}, {near('u', 'u')} AS stop, {near('u - least_in', 'u', 'least_in')} AS expand{over} "
        f"FROM ({best}) t GROUP BY {_list('t', by)} HAVING count(1) = first(n_targets)", **tables)


def _on_the_way(dist: str, mark: str, bound: str) -> str:
    """No landmark L shows that a vertex v lies too far from all targets t of its source:
    d(v, t) >= d(v, L) - d(t, L) and d(v, t) >= d(L, t) - d(L, v).  A vertex that cannot
    reach a landmark which all targets reach cannot reach them either."""
    return f"""(({mark}.to_mark IS NULL OR forall(zip_with({mark}.to_mark, {bound}.over_to,
                     (m, o) -> o IS NULL OR (m IS NOT NULL AND {dist} + m <= o)), x -> x))
                AND ({mark}.from_mark IS NULL OR forall(zip_with({mark}.from_mark, {bound}.over_from,
                     (m, o) -> o IS NULL OR m IS NULL OR {dist} - m <= o), x -> x)))"""


def landmark_table(edges: DataFrame, scenario_cols: Sequence[str] = (), n: int = 4,
                   edges_collapsed: bool = False, **kw) -> DataFrame:
    """<scen>, id, to_mark, from_mark: least costs to and from ``n`` landmarks.

    The landmarks of a scenario are spread by hash over its vertices with three
    out-edges or more (with fewer where there are none).  Both directions are routed together; a distance is null where
    there is no way.  Build it once per graph and hand it to ``route`` or
    ``shortest_paths`` with every set of requests on that graph.
    """
    scen = _cols(scenario_cols)
    spark = edges.sparkSession
    e = _write_read(_usable(edges) if edges_collapsed else collapse_edges(edges, scen), scratch_path(spark, "route-edges"))
    order = [F.least("deg", F.lit(3)).desc(), F.xxhash64("src"), F.col("src")]
    most = out_degrees(e, scen) if scen else out_degrees(e, scen).orderBy(*order).limit(n)
    # filtered on the row number itself: it is then limited in each map task before the shuffle
    marks = (most.withColumn("nth", F.row_number().over(Window.partitionBy(*scen).orderBy(*order)))
             .where(F.col("nth") <= n).select(*scen, F.col("src").alias("source"), (F.col("nth") - 1).alias("mark")))
    marks = _write_read(marks, scratch_path(spark, "route-marks"))
    way = lambda df, x: df.withColumn("_way", F.lit(x))                                             # noqa: E731
    both = way(e, "from").unionByName(way(e.select(*scen, F.col("dst").alias("src"), F.col("src").alias("dst"), "cost"), "to"))
    starts = way(marks, "from").unionByName(way(marks, "to")).drop("mark")
    far = shortest_paths(both, starts, [*scen, "_way"], with_path=False, edges_collapsed=True, **kw).join(marks, [*scen, "source"])
    row = lambda w: F.array(*[F.min(F.when((F.col("_way") == w) & (F.col("mark") == k), F.col("dist"))) for k in range(n)])
    # a search reads it five times
    return _write_read(far.groupBy(*scen, "id").agg(row("to").alias("to_mark"), row("from").alias("from_mark")),
                       scratch_path(spark, "route-landmarks"))


def _store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, name)
    return _write_read(df, path), path


class _Buckets:
    """Tables of the shared folder that are bucketed on ``keys`` like a shuffle on
    them: joins and aggregates on the keys do not move their rows.  Rows come in
    numbered parts; the catalog entry is only there for the bucketing."""

    def __init__(self, spark: SparkSession, name: str, keys: list[str]):
        self.spark, self.keys = spark, keys
        self.base = scratch_path(spark, name)
        self.table = f"roadcast_{self.base.rsplit('/', 1)[-1].replace('-', '_')}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(self, rows: DataFrame, part: int) -> int:
        obs = Observation(f"{self.table}-{part}")
        (rows.observe(obs, F.count(F.lit(1)).alias("n")).withColumn("_part", F.lit(part)).write.mode("append")
         .partitionBy("_part").bucketBy(self.buckets, *self.keys).option("path", self.base).saveAsTable(self.table))
        return obs.get["n"]

    def read(self, parts: list[int]) -> DataFrame:
        return self.spark.table(self.table).where(F.col("_part").isin(parts)).drop("_part")

    def forget(self) -> None:
        """Takes the entry out of the catalog (not the files); frames read by it are void."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _drops_shuffles(spark: SparkSession):
    """Shuffle files of a query go when it has ended: a loop of rounds that are
    written needs the disk of one round only."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def _quiet(spark: SparkSession) -> SparkSession:
    """A session like this one without adaptive execution: what it checkpoints
    keeps the hash partitioning it was written with, and later joins on the
    same keys do not shuffle it again."""
    quiet = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        quiet.conf.set(key, spark.conf.get(key))
    quiet.conf.set("spark.sql.adaptive.enabled", "false")
    # lists are gathered from sorted rows one after the other, not in a map of lists
    quiet.conf.set("spark.sql.execution.useObjectHashAggregateExec", "false")
    return quiet


LOG_PARTS = 8       # parts of the log after which some are merged


class _Log:
    """Append-only log of improved rows: parts 0, 1, ... of one bucketed table.

    It may hold several rows of a key; the best is the answer.
    """

    def __init__(self, spark: SparkSession, keys: list[str], mode: str, name: str = "route-log"):
        self.keys, self.mode, self.next, self.names = keys, mode, 0, None
        self.rows = _Buckets(spark, name, keys)
        self.parts: list[tuple[int, int]] = []
        self.written = self.compactions = 0

    def _write(self, rows: DataFrame) -> tuple[int, int]:
        n = self.rows.write(rows, self.next)
        self.names, self.next = self.names or rows.columns, self.next + 1
        self.written += n
        return self.next - 1, n

    def append(self, rows: DataFrame) -> int:
        self.parts.append(self._write(rows))
        return self.parts[-1][1]

    def read(self, parts: list[tuple[int, int]] | None = None) -> DataFrame:
        return self.rows.read([r for r, _ in parts or self.parts])

    def newest(self) -> DataFrame:
        return self.read(self.parts[-1:])

    def frontier(self) -> DataFrame:
        """The newest part (not empty) by its files: it moves to the edges, so its buckets are of no use."""
        rows = self.newest()
        return rows.sparkSession.read.schema(rows.schema).parquet(f"{self.rows.base}/_part={self.parts[-1][0]}")

    def best(self, rows: DataFrame | None = None) -> DataFrame:
        """One row per key."""
        rest = [c for c in self.names if c not in (*self.keys, "dist", "path")]
        rank = F.struct("dist", *([] if self.mode == "none" else ["path"]))
        rows = self.read() if rows is None else rows
        out = rows.groupBy(*self.keys).agg(F.min(rank).alias("m"), *[F.first(c, ignorenulls=True).alias(c) for c in rest])
        path = F.lit(None).cast(rows.schema["path"].dataType) if self.mode == "none" else F.col("m.path")
        return out.select(*self.keys, F.col("m.dist").alias("dist"), path.alias("path"), *rest)

    def compact(self) -> None:
        """Merge the newest parts, back to one of more than twice their size, once
        they are ``LOG_PARTS``.  The newest of all, the frontier, stays as it is."""
        *old, frontier = self.parts
        rows, at = 0, len(old)
        while at and (at == len(old) or old[at - 1][1] <= 2 * rows):
            at -= 1
            rows += old[at][1]
        if len(old) - at >= LOG_PARTS:
            self.parts = [*old[:at], self._write(self.best(self.read(old[at:]))), frontier]
            self.compactions += 1


def shortest_paths(edges: DataFrame, *args, **kw) -> DataFrame:
    """Least-cost distance (and path) from every source to every reachable vertex.

    edges   : <scen>, src, dst, cost (cost >= 0; parallel edges allowed)
    sources : <scen>, source
    targets : optional <scen>, source, target -- the search of a source is cut
              by what its targets are known to need, and only the targets
              are returned (a pruned search leaves other vertices unsettled).
    landmarks: optional ``landmark_table`` of these edges; used with targets only
    stored  : collapsed edges that are already a Parquet table, and its path
    known   : their ``vertex_table``, if there is one; used with targets only
    Result  : <scen>, source, id, dist, path (array incl. both ends), hops
              -- or, with ``path_mode="parent"``, <scen>, source, id, dist,
              parent: only the predecessor is kept (ties -> smallest
              predecessor, see the module), so the state does not grow with
              route length; ``trace_paths`` rebuilds the paths of the targets
              asked for.  With targets, the rows are those of the tree that
              are final: all within the bound, the targets and the ways to them.

    Every round's improvements are written once to the shared checkpoint folder
    and read back, so a lost executor never replays earlier rounds.
    """
    with _drops_shuffles(edges.sparkSession):
        return _search(edges, *args, **kw)


def _search(edges: DataFrame, sources: DataFrame, scenario_cols: Sequence[str] = (),
                   with_path: bool = True, max_rounds: int | None = None,
                   targets: DataFrame | None = None, fanout_chunk: int = 50_000,
                   partitions: int | None = None, edges_collapsed: bool = False,
                   edges_per_partition: int = 200_000, path_mode: str | None = None,
                   stats: dict | None = None, landmarks: DataFrame | None = None,
                   stored: tuple[DataFrame, str] | None = None,
                   known: DataFrame | None = None, targets_distinct: bool = False) -> DataFrame:
    scen = _cols(scenario_cols)
    spark = edges.sparkSession
    checkpoint_dir(spark)
    t_setup = [time.perf_counter()]
    mode = _path_mode(with_path, path_mode)

    # the edge source (possibly an aggregation over a huge fact table) is read once
    stored = stored or _store(_usable(edges) if edges_collapsed else collapse_edges(edges, scen), "route-edges")
    edges = stored[0]
    id_type = edges.schema["src"].dataType
    sizes = Observation(f"route-degrees-{scratch_path(spark, 'o').rsplit('-', 1)[-1]}")
    if targets is None:
        degrees = edges.groupBy(*scen, "src").agg(F.count(F.lit(1)).alias("deg"), F.min("cost").alias("least"))
    else:
        known = _store(vertex_table(edges, scen), "route-vertices")[0] if known is None else known
        degrees = known.select(*scen, F.col("id").alias("src"), "deg", F.col("least_in").alias("least"))
    degrees = degrees.observe(sizes, F.sum("deg").alias("n"), F.max("deg").alias("d"), F.min("least").alias("c"))
    hubs = _store(_chunks(degrees.drop("least"), fanout_chunk), "route-hubs")
    n_edges, max_deg, min_cost = int(sizes.get["n"] or 0), int(sizes.get["d"] or 0), sizes.get["c"]
    t_setup.append(time.perf_counter())
    if n_edges and min_cost is not None and min_cost < 0:
        raise ValueError(f"edge costs must be >= 0, found {min_cost}")
    n_marks, goals, fewest = 0, None, None
    by = [*scen, "source", "id"]
    if targets is not None:
        targets = targets.select(*scen, F.col("source").cast(id_type).alias("source"),
                                 F.col("target").cast(id_type).alias("target"))
        targets = targets if targets_distinct else targets.distinct()
        asked, asks = _Buckets(spark, "route-goals", by), Observation(f"route-goals-{scratch_path(spark, 'o').rsplit('-', 1)[-1]}")
        asked.write(_goals(known, targets, scen, landmarks).observe(asks, F.min("n_targets").alias("n")), 0)
        goals, fewest = asked.read([0]), asks.get["n"]
        if landmarks is not None:
            n_marks = landmarks.agg(F.max(F.size("to_mark"))).first()[0] or 0
    # width of the co-partitioned edges: follows the counted edges, at least the
    # cluster's parallelism, so a partition never outgrows edges_per_partition by size alone
    n_parts = partitions or max(spark.sparkContext.defaultParallelism, -(-n_edges // edges_per_partition))
    keys = [*scen, "src", "chunk"]
    # partitioned and sorted on the join keys: the frontier join neither
    # shuffles nor re-sorts the edges in any round
    quiet = _quiet(spark)
    lists = [quiet.read.schema(df.schema).parquet(path) for df, path in (stored, hubs)]
    marks = None
    if n_marks:
        marked, at = _store(landmarks, "route-marks")
        marks = quiet.read.schema(marked.schema).parquet(at)
    prepared = (prepare_edges(lists[0], scen, fanout_chunk, collapsed=True, hubs=lists[1], landmarks=marks, partitions=n_parts)
                .sortWithinPartitions(*keys).checkpoint(eager=True))
    prepared.persist(StorageLevel.MEMORY_AND_DISK)
    name = f"roadcast_edges_{scratch_path(spark, 'e').rsplit('-', 1)[-1]}"       # only to pass the plan on
    prepared.createGlobalTempView(name)
    prepared = spark.table(f"global_temp.{name}")
    spark.catalog.dropGlobalTempView(name)

    t_setup.append(time.perf_counter())
    sources = sources.select(*scen, F.col("source").cast(id_type).alias("source"))
    seeds = seed_state(prepared, sources, scen, path_mode=mode, hubs=hubs[0]).drop("changed")
    log = _Log(spark, by, mode)
    hits = _Log(spark, by, "none", "route-hits")

    def bounds() -> DataFrame | None:
        """Written bounds, or none while too few rows are known to hold all targets of any source."""
        if fewest is None or not (n_marks or sum(frontier_sizes) >= fewest):
            return None
        hits.append(_hits(log.newest() if hits.parts else log.read(), goals, scen))
        hits.compact()
        if not (n_marks or hits.written >= fewest):
            return None
        return _write_read(_bound(hits.read(), scen, goals, n_marks), scratch_path(spark, "route-bound"))

    n_changed = log.append(seeds)
    t_setup.append(time.perf_counter())
    rounds = 0
    t_round = [time.perf_counter()]
    frontier_sizes = [n_changed]
    while n_changed:
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError(f"no fixpoint after {max_rounds} rounds "
                               f"({n_changed} vertices still improving)")
        bound = bounds()
        n_changed = log.append(relax(log.read(), prepared, scen, with_path, bound, mode, log.frontier()))
        log.compact()
        rounds += 1
        frontier_sizes.append(n_changed)
        t_round.append(time.perf_counter())
    prepared.unpersist()
    if stats is not None:
        stats.update(rounds=rounds, edges=n_edges, chunked=max_deg > fanout_chunk,
                     frontier=frontier_sizes, written=log.written, compactions=log.compactions,
                     round_s=[round(b - a, 2) for a, b in zip(t_round, t_round[1:])],
                     setup_s=[round(b - a, 2) for a, b in zip(t_setup, t_setup[1:])])
    if goals is None:
        out = log.best()
    elif mode != "parent":
        out = log.best(log.read().join(goals.select(*by), by, "left_semi"))
    else:
        # rows within the bounds are final, and so is every way to a target
        inside = "f.dist <= b.expand" + (f" AND {_on_the_way('f.dist', 'f', 'b')}" if n_marks else "")
        out = log.best().join(goals.select(*by, "n_targets"), by, "left")
        out = out.join(landmarks, [*scen, "id"], "left") if n_marks else out
        found = _hits(log.read(), goals, scen)
        out = spark.sql(f"SELECT f.* FROM {{f}} f LEFT JOIN {{b}} b ON {_on('f', 'b', [*scen, 'source'])} "
                        f"WHERE f.n_targets IS NOT NULL OR b.stop IS NULL OR ({inside})",
                        f=out, b=_bound(found, scen, goals, n_marks))
    # written while the buckets are known: the result does not hang on catalog entries
    out = _write_read(out.select(*scen, "source", "id", "dist", "path"), scratch_path(spark, "route-result"))
    log.rows.forget()
    hits.rows.forget()
    if goals is not None:
        asked.forget()
    if mode == "array":
        return out.withColumn("hops", F.size("path") - 1)
    if mode == "parent":
        return out.withColumn("parent", F.col("path.parent")).drop("path")
    return out.drop("path")


def trace_paths(tree: DataFrame, targets: DataFrame, scenario_cols: Sequence[str] = (),
                max_hops: int | None = None) -> DataFrame:
    """Vertex lists of requested targets from a ``parent``-mode result.

    tree    : <scen>, source, id, dist, parent (from ``shortest_paths``)
    targets : <scen>, source, target
    Result  : <scen>, source, target, path (source ... target), hops -- only
              for reached targets.

    Pointer doubling: with the vertex 2^k steps up known for every row of the
    tree, the known ends of all paths double in one join, so paths of n hops
    take log2(n) steps.  Steps are written to the shared folder and read back.
    """
    scen = _cols(scenario_cols)
    spark = tree.sparkSession
    base = scratch_path(spark, "route-trace")
    tree = _write_read(tree.select(*scen, "source", "id", "parent"), f"{base}/tree")
    jump = tree.where(F.col("parent").isNotNull()).select(*scen, "source", F.col("id").alias("at"), F.col("parent").alias("up"))
    ends = targets.select(*scen, "source", "target").distinct()
    known = (ends.join(tree.select(*scen, "source", F.col("id").alias("target")), [*scen, "source", "target"])
             .select(*scen, "source", "target", F.lit(0).alias("place"), F.col("target").alias("at")))
    parts, step = [f"{base}/p=0"], 0
    known = _write_read(known, parts[0])
    schema = known.schema
    while True:
        obs = Observation(f"trace-{base.rsplit('-', 1)[-1]}-{step}")
        more = (known.join(jump, [*scen, "source", "at"])
                .select(*scen, "source", "target", (F.col("place") + (1 << step)).alias("place"), F.col("up").alias("at")))
        parts.append(f"{base}/p={step + 1}")
        more.observe(obs, F.count(F.lit(1)).alias("n"), F.max("place").alias("far")).write.parquet(parts[-1])
        if max_hops is not None and (obs.get["far"] or 0) > max_hops:
            raise RuntimeError(f"paths longer than {max_hops} hops")
        known = spark.read.schema(schema).parquet(*parts)
        if not obs.get["n"]:
            break
        over = jump.select(*scen, "source", F.col("at").alias("up"), F.col("up").alias("higher"))
        jump = _write_read(jump.join(over, [*scen, "source", "up"]).select(*scen, "source", "at", F.col("higher").alias("up")),
                           f"{base}/jump={step + 1}")
        step += 1
    ways = known.groupBy(*scen, "source", "target").agg(
        F.transform(F.reverse(F.array_sort(F.collect_list(F.struct("place", "at")))), lambda x: x["at"]).alias("path"))
    return ways.select(*scen, "source", "target", "path", (F.size("path") - 1).alias("hops"))


# --------------------------------------------------------------------------
# G6 / G7 / G8: point-to-point answers with status
# --------------------------------------------------------------------------
def route(edges: DataFrame, *args, **kw) -> DataFrame:
    """Answer (src, dst) requests, optionally per scenario.

    pairs  : <scen>, src, dst
    Result : <scen>, src, dst, status, total, path, hops
    status : ok | src_missing | dst_missing | unreachable (dst checked first,
             as the reference does); total/path/hops are null unless ok.
    path_mode: ``array`` carries every path in the state (ties -> smallest
             path); ``parent`` keeps only predecessors (ties -> smallest
             predecessor) and traces the requested paths afterwards -- the
             state then stays small however long the routes are.
    landmarks (in ``kw``): a ``landmark_table`` of the edges, for goal-directed search.
    """
    with _drops_shuffles(edges.sparkSession):
        return _route(edges, *args, **kw)


def _route(edges: DataFrame, pairs: DataFrame, scenario_cols: Sequence[str] = (),
           vertices: str = "both", prune: bool = True, path_mode: str = "array",
           edges_collapsed: bool = False, **kw) -> DataFrame:
    if path_mode not in ("array", "parent"):
        raise ValueError(f"path_mode must be 'array' or 'parent', got {path_mode!r}")
    scen = _cols(scenario_cols)
    id_type = edges.schema["src"].dataType
    pairs = pairs.select(*scen, F.col("src").cast(id_type).alias("src"),
                         F.col("dst").cast(id_type).alias("dst")).distinct()
    # requests may be derived from facts, and are read three times
    pairs = _write_read(pairs, scratch_path(edges.sparkSession, "route-pairs"))
    # read the edge source once: vertex set, routing and status all use this copy
    edges, _ = stored = _store(_usable(edges) if edges_collapsed else collapse_edges(edges, scen), "route-edges")
    if vertices not in ("both", "src"):
        raise ValueError(f"vertices must be 'both' or 'src', got {vertices!r}")
    # ends, degrees and cheapest edges in: one aggregate for the checks and the search
    known, _ = _store(vertex_table(edges, scen), "route-vertices")
    if vertices == "src":
        known = known.where(F.col("deg") > 0)
    # of sources there are few beside their requests: looked up apart, in a short table
    asking = pairs.select(*scen, "src").distinct()
    known_src = _write_read(known.select(*scen, F.col("id").alias("src")).join(asking, [*scen, "src"], "left_semi")
                            .withColumn("src_known", F.lit(True)), scratch_path(edges.sparkSession, "route-sources"))
    known_dst = known.select(*scen, F.col("id").alias("dst"), F.lit(True).alias("dst_known"))
    # requests with their vertex checks, materialised once: used for the seeds
    # and again for the answer
    checked = _write_read(pairs.join(known_src, [*scen, "src"], "left")
                          .join(known_dst, [*scen, "dst"], "left"),
                          scratch_path(edges.sparkSession, "route-requests"))
    runnable = checked.where(F.col("src_known") & F.col("dst_known"))
    sources = runnable.select(*scen, F.col("src").alias("source"))
    targets = runnable.select(*scen, F.col("src").alias("source"), F.col("dst").alias("target"))
    if vertices == "src":
        # a sink-only vertex is not a vertex: edges into it are lost
        starts = known.select(*scen, F.col("id").alias("dst"))
        stored = _store(edges.join(starts, [*scen, "dst"], "left_semi").select(*edges.columns), "route-edges")
    sp = shortest_paths(edges, sources, scen, path_mode=path_mode, targets=targets if prune else None,
                        stored=stored, known=known, targets_distinct=True, **kw)
    if path_mode == "parent":
        traced = trace_paths(sp, targets, scen)
        sp = (sp.select(*scen, "source", "id", "dist")
              .join(traced.withColumnRenamed("target", "id"), [*scen, "source", "id"]))
    reached = sp.select(*scen, F.col("source").alias("src"), F.col("id").alias("dst"),
                        F.col("dist").alias("total"), "path", "hops")
    res = checked.join(reached, [*scen, "src", "dst"], "left")
    status = (F.when(F.col("dst_known").isNull(), F.lit(STATUS_DST_MISSING))
              .when(F.col("src_known").isNull(), F.lit(STATUS_SRC_MISSING))
              .when(F.col("total").isNull(), F.lit(STATUS_UNREACHABLE))
              .otherwise(F.lit(STATUS_OK)))
    return res.select(*scen, "src", "dst", status.alias("status"), "total", "path", "hops")
