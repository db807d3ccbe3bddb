"""Registered queries for the end-to-end jobs (Q1, Q3, Q4, Q5).

Speed rows: one per line of ``lineitem`` joined to its order -- date = order
date, link = part, from/to = nation names of supplier and customer (string
junction names, as in the reference), distance = quantity * 100 m, speed at
10h = discount * 100 km/h, at 15h = tax * 100 km/h, period = order month.
Condition observations: per ship day and line status ("station"), the
number of lines and the quantity shipped, observed at 10:00, labelled by
the nearest of three fixed centres.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cluster as M
from ..session import scratch_path, write_read
from . import jobs as J
from .common import load, register, ts_text
from .graph_checks import _route_sql

WIDE_SQL = """
  w AS (SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date, l_partkey AS link_id,
               sn.n_name AS from_node, cn.n_name AS to_node, l_quantity * 100 AS distance_m,
               l_discount * 100 AS h10, l_tax * 100 AS h15, l_orderkey, l_linenumber,
               date_trunc('month', o_orderdate) AS period
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey
        JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN nation cn ON c_nationkey = cn.n_nationkey),
  dim AS (SELECT link_id, from_node, to_node FROM w WHERE period = (SELECT max(period) FROM w)
          QUALIFY row_number() OVER (PARTITION BY link_id
                                     ORDER BY date DESC, l_orderkey DESC, l_linenumber DESC) = 1),
  cw AS (SELECT w.date, w.link_id, dim.from_node, dim.to_node, w.distance_m, w.h10, w.h15
         FROM w JOIN dim ON w.link_id = dim.link_id),
  lg AS (SELECT date, link_id, from_node, to_node, distance_m, 10 AS hour, h10 AS speed_kmh FROM cw
         UNION ALL SELECT date, link_id, from_node, to_node, distance_m, 15, h15 FROM cw),
  tf AS (SELECT * FROM (
           SELECT CAST(strptime(CAST(date AS VARCHAR), '%Y%m%d') AS DATE) AS date, link_id, from_node,
                  to_node, distance_m, speed_kmh, hour,
                  distance_m / nullif(speed_kmh / 3.6, 0) AS travel_s,
                  strptime(CAST(date AS VARCHAR), '%Y%m%d') + to_hours(hour) AS ts
           FROM lg) WHERE travel_s IS NOT NULL)"""

COND_CENTERS = [[5.0, 100.0], [12.0, 300.0], [20.0, 500.0]]


def _cond_assign_sql():
    ds = ", ".join(
        f"(0.0 + ({a!r} - n_lines) * ({a!r} - n_lines) + ({b!r} - qty) * ({b!r} - qty))"
        for a, b in COND_CENTERS)
    return f"CAST(list_position([{ds}], list_min([{ds}])) - 1 AS INTEGER)"


OBS_SQL = f"""
  obs AS (SELECT l_shipdate + INTERVAL 10 HOUR AS ts, l_linestatus AS station,
                 CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS qty
          FROM lineitem GROUP BY 1, 2),
  cond AS (SELECT ts, station, n_lines, qty, {_cond_assign_sql()} AS condition FROM obs)"""
COND_SQL = f"""{OBS_SQL},
  cond1 AS (SELECT ts, condition FROM cond
            QUALIFY row_number() OVER (PARTITION BY ts ORDER BY station DESC) = 1),
  lf AS (SELECT tf.*, coalesce(cond1.condition, -1) AS condition
         FROM tf LEFT JOIN cond1 ON tf.ts = cond1.ts)"""


def speed_wide(spark, sf_dir):
    li, od = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    su, cu, na = (load(spark, sf_dir, t) for t in ("supplier", "customer", "nation"))
    sn = na.select(F.col("n_nationkey").alias("s_nk"), F.col("n_name").alias("from_node"))
    cn = na.select(F.col("n_nationkey").alias("c_nk"), F.col("n_name").alias("to_node"))
    # customers are joined to orders first: lines, of which there are most, move for their order only
    of = od.join(cu, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderdate", "c_nationkey")
    w = (li.join(su, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(of, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(sn, F.col("s_nationkey") == F.col("s_nk"))
         .join(cn, F.col("c_nationkey") == F.col("c_nk")))
    return w.select(F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date"),
                    F.col("l_partkey").alias("link_id"), "from_node", "to_node",
                    (F.col("l_quantity") * 100).alias("distance_m"),
                    (F.col("l_discount") * 100).alias("10시"), (F.col("l_tax") * 100).alias("15시"),
                    "l_orderkey", "l_linenumber",
                    F.date_trunc("month", "o_orderdate").alias("period"))


def traffic_facts(spark, sf_dir):
    wide = write_read(speed_wide(spark, sf_dir), scratch_path(spark, "speed-wide"))     # four joins: evaluated once
    return J.prepare_traffic(wide, ["10시", "15시"],
                             tiebreak=["l_orderkey", "l_linenumber"])


def observations(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    obs = li.groupBy(F.timestamp_add("HOUR", F.lit(10), F.col("l_shipdate")).alias("ts"),
                     F.col("l_linestatus").alias("station")).agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"), F.sum("l_quantity").alias("qty"))
    return M.assign_condition(obs, COND_CENTERS, ["n_lines", "qty"])


def labelled_facts(spark, sf_dir):
    return J.label_traffic(traffic_facts(spark, sf_dir), observations(spark, sf_dir),
                           order=["station"])


def _fact_text(df):
    return df.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "link_id", "from_node",
                     "to_node", "distance_m", "speed_kmh", "hour", "travel_s",
                     ts_text("ts").alias("ts"), *(["condition"] if "condition" in df.columns else []))


FACT_TEXT_SQL = """date::VARCHAR AS date, link_id, from_node, to_node, distance_m, speed_kmh, hour,
       travel_s, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts"""


@register("pipe_prepare_traffic", oracle=f"WITH {WIDE_SQL} SELECT {FACT_TEXT_SQL} FROM tf")
def q_pipe_prepare_traffic(spark, sf_dir):
    return _fact_text(traffic_facts(spark, sf_dir))


@register("pipe_label_traffic", oracle=f"WITH {WIDE_SQL}, {COND_SQL} SELECT {FACT_TEXT_SQL}, condition FROM lf")
def q_pipe_label_traffic(spark, sf_dir):
    return _fact_text(labelled_facts(spark, sf_dir))


@register("pipe_condition_report", oracle=f"""
WITH {OBS_SQL}
SELECT condition, round(avg(n_lines), 4) AS avg_n_lines, round(avg(qty), 4) AS avg_qty,
       count(condition) AS n
FROM cond GROUP BY condition""")
def q_pipe_condition_report(spark, sf_dir):
    _, profile = J.condition_report(observations(spark, sf_dir), "condition", ["n_lines", "qty"])
    return profile.select("condition", F.round("avg_n_lines", 4).alias("avg_n_lines"),
                          F.round("avg_qty", 4).alias("avg_qty"), "n")


ROUTE_EDGES_SQL = f"""{WIDE_SQL}, {COND_SQL},
  e AS (SELECT condition, hour, from_node AS src, to_node AS dst,
               avg(floor(travel_s * 1024) / 1024) AS cost
        FROM lf GROUP BY condition, hour, link_id, from_node, to_node)"""
ROUTE_REQ_SQL = """
  req AS (SELECT condition, hour, 'NATION_0' AS src, to_node AS dst FROM lf
          UNION SELECT condition, hour, from_node, to_node FROM lf)"""


@register("pipe_routes", oracle=_route_sql(ROUTE_EDGES_SQL, ROUTE_REQ_SQL, ["condition", "hour"],
                                          "both", dist_type="DOUBLE"))
def q_pipe_routes(spark, sf_dir):
    # travel times in whole 1/1024 s: their sums are exact, so both engines get
    # the same means whatever the order of summation
    facts = labelled_facts(spark, sf_dir).select("condition", "hour", "link_id", "from_node", "to_node",
                                                 (F.floor(F.col("travel_s") * 1024) / 1024).alias("travel_s"))
    facts = write_read(facts, scratch_path(spark, "labelled"))      # read for the requests and for the edges
    pairs = facts.select("condition", "hour", F.lit("NATION_0").alias("src"), F.col("to_node").alias("dst")).unionByName(
        facts.select("condition", "hour", F.col("from_node").alias("src"), F.col("to_node").alias("dst"))).distinct()
    res = J.routes_by_scenario(facts, pairs, ["condition", "hour"])
    return res.select("condition", "hour", "src", "dst", "status", "total",
                      F.array_join("path", ",").alias("path"), "hops")
