"""Registered queries for the table operators (P*, F*, J*, A*, W1, O*, U1, E*).

Analogy with the reference's data (SURVEY 7.3): a travel-time fact is a line
of ``lineitem`` joined to its order; the link is the part, from/to are the
supplier and the customer, the scenario is (return flag, order priority);
sparse labels are ``labels`` over ``documents``; a time series is ``events``
per user.  Money is compared as integer cents, averages of doubles rounded
to 4 places, timestamps as text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import clean as C
from ..operators import lookup as L
from ..operators import report as R
from .common import cents, load, register, ts_text

LINE_KEYS = ["l_orderkey", "l_linenumber"]


def trade_facts(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    od = load(spark, sf_dir, "orders")
    return li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


# ---------------------------------------------------------------- P1 / P2 / P4
@register("proj_by_name", oracle="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem""")
def q_proj_by_name(spark, sf_dir):
    return C.project(load(spark, sf_dir, "lineitem"),
                     ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"])


@register("proj_by_position", oracle="""
SELECT l_linenumber, l_quantity, l_extendedprice FROM lineitem""")
def q_proj_by_position(spark, sf_dir):
    return C.project_slice(load(spark, sf_dir, "lineitem"), 3, 6)


@register("proj_drop", oracle="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_returnflag FROM lineitem""")
def q_proj_drop(spark, sf_dir):
    return C.drop_columns(load(spark, sf_dir, "lineitem"),
                          ["l_comment", "l_tax", "l_shipdate", "l_linestatus", "no_such_column"])


# ---------------------------------------------------------------- P5 / F2 / E3
@register("expr_travel_time", oracle="""
SELECT * FROM (
  SELECT l_orderkey, l_linenumber,
         l_extendedprice / nullif(l_discount * 100 / 3.6, 0) AS travel_s
  FROM lineitem) WHERE travel_s IS NOT NULL""")
def q_expr_travel_time(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    out = li.select(*LINE_KEYS, X.travel_time("l_extendedprice", F.col("l_discount") * 100)
                    .alias("travel_s"))
    return out.where(F.col("travel_s").isNotNull())


# ---------------------------------------------------------------- E4 / E5 / P8
@register("expr_timestamp", oracle="""
SELECT o_orderkey, day, hour,
       strftime(try_strptime(day, '%Y%m%d') + to_hours(hour), '%Y-%m-%d %H:%M:%S') AS ts
FROM (SELECT o_orderkey,
             CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE strftime(o_orderdate, '%Y%m%d') END AS day,
             CAST(o_orderkey % 25 AS INTEGER) AS hour
      FROM orders)""")
def q_expr_timestamp(spark, sf_dir):
    od = load(spark, sf_dir, "orders")
    base = od.select("o_orderkey",
                     F.when(F.col("o_orderstatus") == "P", F.lit("n/a"))
                     .otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("day"),
                     (F.col("o_orderkey") % 25).cast("int").alias("hour"))
    return base.withColumn("ts", ts_text(X.hour_timestamp("day", "hour")))


# ---------------------------------------------------------------- P6 / P7
@register("reshape_hours_long", oracle="""
SELECT l_orderkey, l_linenumber, 10 AS hour, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 15, l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 24, l_tax FROM lineitem""")
def q_reshape_hours_long(spark, sf_dir):
    return C.hours_to_long(load(spark, sf_dir, "lineitem"), LINE_KEYS,
                           {"l_quantity": 10, "l_discount": 15, "l_tax": 24}, value="value")


# ---------------------------------------------------------------- F1 / A1
SCENARIO_SQL = """
  f AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_returnflag = 'R' AND o_orderpriority = '1-URGENT')"""
SCENARIO = {"l_returnflag": "R", "o_orderpriority": "1-URGENT"}


@register("filter_scenario", oracle=f"""
WITH {SCENARIO_SQL}
SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) AS cost FROM f""")
def q_filter_scenario(spark, sf_dir):
    f = C.for_scenario(trade_facts(spark, sf_dir), SCENARIO)
    return f.select(*LINE_KEYS, cents("l_extendedprice").alias("cost"))


@register("agg_edge_cost", oracle=f"""
WITH {SCENARIO_SQL}
SELECT l_partkey AS link_id, l_suppkey AS from_node, o_custkey AS to_node,
       avg(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cost
FROM f GROUP BY 1, 2, 3""")
def q_agg_edge_cost(spark, sf_dir):
    f = C.for_scenario(trade_facts(spark, sf_dir), SCENARIO)
    f = f.select(F.col("l_partkey").alias("link_id"), F.col("l_suppkey").alias("from_node"),
                 F.col("o_custkey").alias("to_node"), cents("l_extendedprice").alias("cost"))
    return R.edge_costs(f, ["link_id", "from_node", "to_node"], "cost")


# ---------------------------------------------------------------- F3 / J5 / J1 / A6
NEWEST_SQL = """
  nm AS (SELECT * FROM lineitem
         WHERE date_trunc('month', l_shipdate) = (SELECT max(date_trunc('month', l_shipdate)) FROM lineitem))"""


@register("join_semi_known", oracle=f"""
WITH {NEWEST_SQL}
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey IN (SELECT l_partkey FROM nm)""")
def q_join_semi_known(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").withColumn("period", F.date_trunc("month", "l_shipdate"))
    known = L.keys_in_newest(li, "l_partkey", "period")
    return L.keep_known(li, known, "l_partkey").select(*LINE_KEYS, "l_partkey")


@register("join_conform_latest", oracle="""
WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, l_shipdate,
                  date_trunc('month', l_shipdate) AS period
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  dim AS (SELECT l_partkey, l_suppkey, o_custkey FROM f
          WHERE period = (SELECT max(period) FROM f)
          QUALIFY row_number() OVER (PARTITION BY l_partkey
                                     ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1)
SELECT f.l_orderkey, f.l_linenumber, f.l_partkey AS link_id,
       dim.l_suppkey AS from_node, dim.o_custkey AS to_node
FROM f JOIN dim ON f.l_partkey = dim.l_partkey""")
def q_join_conform_latest(spark, sf_dir):
    f = trade_facts(spark, sf_dir).select(
        *LINE_KEYS, F.col("l_partkey").alias("link_id"), F.col("l_suppkey").alias("from_node"),
        F.col("o_custkey").alias("to_node"), "l_shipdate",
        F.date_trunc("month", "l_shipdate").alias("period"))
    out = L.conform_to_latest(f, "link_id", ["from_node", "to_node"], "period",
                              ["l_shipdate", "l_orderkey", "l_linenumber"])
    return out.select(*LINE_KEYS, "link_id", "from_node", "to_node")


@register("win_latest_per_key", oracle="""
SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipped
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey
                           ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1""")
def q_win_latest_per_key(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", *LINE_KEYS, "l_shipdate")
    out = L.latest_per_key(li, "l_partkey", ["l_shipdate", "l_orderkey", "l_linenumber"])
    return out.select("l_partkey", "l_suppkey", *LINE_KEYS, ts_text("l_shipdate").alias("shipped"))


@register("agg_distinct_key", oracle="SELECT DISTINCT o_custkey FROM orders")
def q_agg_distinct_key(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_custkey").dropDuplicates(["o_custkey"])


# ---------------------------------------------------------------- J2 and null handling
DOC_LABELS_SQL = """
  dl AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
         FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def doc_labels(spark, sf_dir):
    d = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return d.join(load(spark, sf_dir, "labels"), "doc_id", "left")


@register("join_lookup_default", oracle="""
SELECT d.doc_id, d.lang, coalesce(l.quality, -1) AS quality
FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l
  ON d.doc_id = l.doc_id""")
def q_join_lookup_default(spark, sf_dir):
    d = load(spark, sf_dir, "documents").select("doc_id", "lang")
    return L.lookup_default(d, load(spark, sf_dir, "labels"), "doc_id", "quality", -1)


@register("clean_drop_nulls", oracle=f"""
WITH {DOC_LABELS_SQL}
SELECT doc_id, quality, toxic FROM dl WHERE quality IS NOT NULL AND toxic IS NOT NULL""")
def q_clean_drop_nulls(spark, sf_dir):
    return C.require(doc_labels(spark, sf_dir), ["quality", "toxic"]).select("doc_id", "quality", "toxic")


@register("clean_fill_nulls", oracle=f"""
WITH {DOC_LABELS_SQL}
SELECT doc_id, lang, n_chars, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic FROM dl""")
def q_clean_fill_nulls(spark, sf_dir):
    filled = C.fill_numeric(C.fill_defaults(doc_labels(spark, sf_dir), {"quality": -1}), 0)
    return filled.select("doc_id", "lang", "n_chars", "quality", "toxic")


@register("audit_null_counts", oracle=f"""
WITH {DOC_LABELS_SQL}
SELECT count(*) FILTER (WHERE doc_id IS NULL) AS doc_id, count(*) FILTER (WHERE lang IS NULL) AS lang,
       count(*) FILTER (WHERE source IS NULL) AS source, count(*) FILTER (WHERE n_chars IS NULL) AS n_chars,
       count(*) FILTER (WHERE quality IS NULL) AS quality, count(*) FILTER (WHERE toxic IS NULL) AS toxic
FROM dl""")
def q_audit_null_counts(spark, sf_dir):
    return C.null_counts(doc_labels(spark, sf_dir))


# ---------------------------------------------------------------- W1
@register("win_forward_fill", oracle="""
SELECT event_id, user_id,
       last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
         OVER (PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase
FROM events""")
def q_win_forward_fill(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("last_purchase"))
    out = C.forward_fill(ev, ["last_purchase"], ["user_id"], ["ts", "event_id"],
                         bucket=F.date_trunc("day", "ts"))
    return out.select("event_id", "user_id", "last_purchase")


# ---------------------------------------------------------------- A2 / A3 / A8 / O1
@register("agg_cluster_profile", oracle="""
SELECT event_type, round(avg(value), 4) AS avg_value, count(event_type) AS n
FROM events GROUP BY event_type""")
def q_agg_cluster_profile(spark, sf_dir):
    p = R.cluster_profile(load(spark, sf_dir, "events"), "event_type", ["value"])
    return p.withColumn("avg_value", F.round("avg_value", 4))


@register("agg_mean_all_numeric", oracle="""
SELECT event_type, avg(event_id) AS avg_event_id, avg(user_id) AS avg_user_id,
       round(avg(value), 4) AS avg_value
FROM events GROUP BY event_type""")
def q_agg_mean_all_numeric(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type")
    return R.cluster_profile(ev, "event_type").withColumn("avg_value", F.round("avg_value", 4))


@register("agg_cluster_summary", oracle="""
SELECT max(label) AS max_label, count(DISTINCT label) AS n_labels, count(*) AS n_rows FROM embeddings""")
def q_agg_cluster_summary(spark, sf_dir):
    return R.cluster_summary(load(spark, sf_dir, "embeddings"), "label")


# ---------------------------------------------------------------- A5 / O2 / O3
@register("agg_argmin", oracle="""
SELECT l_partkey, cost, l_suppkey, l_orderkey, l_linenumber FROM (
  SELECT l_partkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS cost, l_suppkey, l_orderkey, l_linenumber
  FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY cost, l_suppkey, l_orderkey, l_linenumber) = 1""")
def q_agg_argmin(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").withColumn("cost", cents("l_extendedprice"))
    return R.argmin(li, ["l_partkey"], ["cost", "l_suppkey", "l_orderkey", "l_linenumber"])


@register("topk_per_group", oracle="""
SELECT l_partkey, l_orderkey, l_linenumber, cost,
       row_number() OVER (PARTITION BY l_partkey ORDER BY cost, l_orderkey, l_linenumber) AS rank
FROM (SELECT l_partkey, l_orderkey, l_linenumber,
             CAST(round(l_extendedprice * 100) AS BIGINT) AS cost FROM lineitem)
QUALIFY rank <= 3""")
def q_topk_per_group(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select(
        "l_partkey", *LINE_KEYS, cents("l_extendedprice").alias("cost"))
    return R.top_per_group(li, ["l_partkey"],
                           [F.col("cost"), F.col("l_orderkey"), F.col("l_linenumber")], n=3)


# ---------------------------------------------------------------- A7 / U1
@register("agg_row_counts", oracle="""
SELECT 'orders' AS "table", count(*) AS rows FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'events', count(*) FROM events""")
def q_agg_row_counts(spark, sf_dir):
    return R.row_counts({t: load(spark, sf_dir, t) for t in ("orders", "lineitem", "events")})


@register("set_union_all", oracle="""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'A'
UNION ALL SELECT l_orderkey, l_linenumber, NULL FROM lineitem WHERE l_returnflag = 'N'""")
def q_set_union_all(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    return C.union_all([
        li.where(flag == "R").select("l_orderkey", "l_linenumber", "l_quantity"),
        li.where(flag == "A").select("l_quantity", "l_linenumber", "l_orderkey"),  # other order
        li.where(flag == "N").select("l_orderkey", "l_linenumber"),  # missing column -> null
    ])
