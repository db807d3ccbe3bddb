"""Registered queries for condition clustering (M1-M7, S8/K2, Q2).

Condition observations are hourly summaries of ``events`` (the analogue of
hourly weather): integer-valued sums of cents per event type, with natural
gaps (an hour without purchases has no "rain").  Fitting k-means is
randomised, so ``ml_kmeans``, ``ml_sweep_k`` and ``pipe_prepare_weather``
are rows-only; assignment to fixed centres and the silhouette are compared
exactly (silhouette rounded to 6 places).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cluster as M
from ..sources import files as S
from ..session import scratch_path
from . import jobs as J
from .common import cents, load, register, ts_text

HOURLY_SQL = """
  h AS (SELECT date_trunc('hour', ts) AS ts,
               CAST(sum(CASE WHEN event_type = 'view' THEN CAST(round(value * 100) AS BIGINT) END) AS DOUBLE) AS temp_c,
               CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) END) AS DOUBLE) AS rain_mm,
               CAST(sum(CASE WHEN event_type = 'error' THEN CAST(round(value * 100) AS BIGINT) END) AS DOUBLE) AS snow_cm,
               CAST(count(*) AS DOUBLE) AS wind_ms,
               CAST(nullif(count(*) FILTER (WHERE event_type = 'click'), 0) AS DOUBLE) AS cloud
        FROM events GROUP BY 1)"""


def hourly_observations(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    c = cents("value")
    t = F.col("event_type")
    return ev.groupBy(F.date_trunc("hour", "ts").alias("ts")).agg(
        F.sum(F.when(t == "view", c)).cast("double").alias("temp_c"),
        F.sum(F.when(t == "purchase", c)).cast("double").alias("rain_mm"),
        F.sum(F.when(t == "error", c)).cast("double").alias("snow_cm"),
        F.count(F.lit(1)).cast("double").alias("wind_ms"),
        F.nullif(F.count_if(t == "click"), F.lit(0)).cast("double").alias("cloud"))


# the full-mode chain on the columns the hourly table has
HOURLY_FULL = M.PrepSpec(
    name="full",
    drop=("station", "station_name"),
    fill={"rain_mm": -1.0, "snow_cm": -1.0},
    require=("temp_c", "wind_ms"),
    ffill={"cloud": "cloud_filled"},
    require_after=("cloud",),
    features=("temp_c", "rain_mm", "snow_cm", "wind_ms", "cloud", "cloud_filled"),
)
HOURLY_COMPACT = M.PrepSpec(
    name="compact",
    select=("ts", "temp_c", "rain_mm", "snow_cm"),
    require=("temp_c",),
    fill_numeric=0.0,
    features=("temp_c", "rain_mm", "snow_cm"),
)
FULL_SQL = f"""
WITH {HOURLY_SQL},
  f AS (SELECT ts, temp_c, coalesce(rain_mm, -1) AS rain_mm, coalesce(snow_cm, -1) AS snow_cm, wind_ms, cloud
        FROM h WHERE temp_c IS NOT NULL AND wind_ms IS NOT NULL),
  g AS (SELECT *, last_value(cloud IGNORE NULLS) OVER (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                  AS cloud_filled FROM f)
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, temp_c, rain_mm, snow_cm, wind_ms, cloud, cloud_filled
FROM g WHERE cloud IS NOT NULL"""
COMPACT_SQL = f"""
WITH {HOURLY_SQL}
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, temp_c, coalesce(rain_mm, 0) AS rain_mm,
       coalesce(snow_cm, 0) AS snow_cm
FROM h WHERE temp_c IS NOT NULL"""


def _day(c="ts"):
    return F.date_trunc("day", F.col(c))


@register("prep_full_mode", oracle=FULL_SQL)
def q_prep_full_mode(spark, sf_dir):
    out = M.prep_conditions(hourly_observations(spark, sf_dir), HOURLY_FULL, bucket=_day())
    return out.select(ts_text("ts").alias("ts"), *HOURLY_FULL.features)


@register("prep_compact_mode", oracle=COMPACT_SQL)
def q_prep_compact_mode(spark, sf_dir):
    out = M.prep_conditions(hourly_observations(spark, sf_dir), HOURLY_COMPACT)
    return out.select(ts_text("ts").alias("ts"), *HOURLY_COMPACT.features)


@register("ml_assemble", oracle=f"""
SELECT ts, temp_c AS f0, rain_mm AS f1, snow_cm AS f2, wind_ms AS f3, cloud AS f4, cloud_filled AS f5
FROM ({FULL_SQL})""")
def q_ml_assemble(spark, sf_dir):
    out = M.prep_and_assemble(hourly_observations(spark, sf_dir), HOURLY_FULL, bucket=_day())
    arr = M.features_to_array("features")
    return out.select(ts_text("ts").alias("ts"),
                      *[arr[i].alias(f"f{i}") for i in range(len(HOURLY_FULL.features))])


# fixed centres of the assignment proof (model parameters, in cents per hour)
FIXED_CENTERS = [[0.0, 0.0, 0.0], [3000.0, 3000.0, 3000.0], [8000.0, 2000.0, 2000.0],
                 [2000.0, 8000.0, 5000.0]]


def _dist_sql(center, cols):
    terms = " + ".join(f"({c!r} - {x}) * ({c!r} - {x})" for c, x in zip(center, cols))
    return f"(0.0 + {terms})"


def _assign_sql(centers, cols):
    ds = ", ".join(_dist_sql(c, cols) for c in centers)
    return f"CAST(list_position([{ds}], list_min([{ds}])) - 1 AS INTEGER)"


@register("ml_assign_fixed", oracle=f"""
SELECT ts, {_assign_sql(FIXED_CENTERS, ["temp_c", "rain_mm", "snow_cm"])} AS condition
FROM ({COMPACT_SQL})""")
def q_ml_assign_fixed(spark, sf_dir):
    out = M.prep_conditions(hourly_observations(spark, sf_dir), HOURLY_COMPACT)
    out = M.assign_condition(out, FIXED_CENTERS, HOURLY_COMPACT.features)
    return out.select(ts_text("ts").alias("ts"), "condition")


@register("ml_kmeans")
def q_ml_kmeans(spark, sf_dir):
    feats = M.prep_and_assemble(hourly_observations(spark, sf_dir), HOURLY_COMPACT)
    model = M.fit_conditions(feats, 4, seed=42)
    return model.transform(feats).select(ts_text("ts").alias("ts"), "condition")


SILHOUETTE_SQL = """
WITH dims AS (SELECT vec_id, label, CAST(x AS DOUBLE) AS x, d
              FROM (SELECT vec_id, label, unnest(embedding) AS x,
                           unnest(range(len(embedding))) AS d FROM embeddings)),
  pn AS (SELECT vec_id, label, sum(x * x) AS sq FROM dims GROUP BY 1, 2),
  cs AS (SELECT label, d, sum(x) AS sx FROM dims GROUP BY 1, 2),
  cn AS (SELECT label, count(*) AS n, sum(sq) AS sqs FROM pn GROUP BY 1),
  dt AS (SELECT p.vec_id, cs.label AS c, sum(p.x * cs.sx) AS dot
         FROM dims p JOIN cs ON p.d = cs.d GROUP BY 1, 2),
  md AS (SELECT pn.vec_id, pn.label, dt.c, cn.n, pn.sq + cn.sqs / cn.n - 2 * dt.dot / cn.n AS m
         FROM pn JOIN dt ON pn.vec_id = dt.vec_id JOIN cn ON cn.label = dt.c),
  pt AS (SELECT vec_id, max(CASE WHEN c = label THEN n END) AS own_n,
                max(CASE WHEN c = label THEN m * n / (n - 1) END) AS a,
                min(CASE WHEN c <> label THEN m END) AS b
         FROM md GROUP BY vec_id),
  co AS (SELECT CASE WHEN own_n = 1 THEN 0.0 WHEN a < b THEN 1 - a / b
                     WHEN a > b THEN b / a - 1 ELSE 0.0 END AS s FROM pt)
SELECT round(avg(s), 6) AS silhouette FROM co"""


def embeddings_silhouette(spark, sf_dir) -> float:
    emb = M.features_from_array(load(spark, sf_dir, "embeddings"), "embedding")
    return M.silhouette(emb, "features", "label")


@register("ml_silhouette", oracle=SILHOUETTE_SQL)
def q_ml_silhouette(spark, sf_dir):
    s = embeddings_silhouette(spark, sf_dir)
    return spark.range(1).select(F.round(F.lit(s), 6).alias("silhouette"))


@register("ml_sweep_k")
def q_ml_sweep_k(spark, sf_dir):
    feats = M.prep_and_assemble(hourly_observations(spark, sf_dir), HOURLY_COMPACT)
    return M.sweep_k(feats, [2, 3, 4], seed=42)


@register("io_cluster_meta", oracle=f"""
SELECT s.silhouette, (SELECT count(DISTINCT label) FROM embeddings) AS k, 'label' AS mode,
       'vec_id,embedding,label' AS columns
FROM ({SILHOUETTE_SQL}) s""")
def q_io_cluster_meta(spark, sf_dir):
    path = scratch_path(spark, "cluster-meta")
    emb = load(spark, sf_dir, "embeddings")
    k = emb.agg(F.count_distinct("label")).first()[0]
    sil = embeddings_silhouette(spark, sf_dir)
    meta = spark.createDataFrame(S.cluster_meta(sil, k, "label", emb.columns), S.CLUSTER_META_SCHEMA)
    S.write_cluster_meta(meta.withColumn("silhouette", F.lit(None).cast("double")), path)
    S.write_cluster_meta(meta, path)  # overwrites
    back = S.read_cluster_meta(spark, path)
    return back.select(F.round("silhouette", 6).alias("silhouette"), "k", "mode",
                       F.array_join("columns", ",").alias("columns"))


@register("pipe_prepare_weather")
def q_pipe_prepare_weather(spark, sf_dir):
    model = J.prepare_conditions(hourly_observations(spark, sf_dir), HOURLY_FULL, k=3, seed=42)
    return model.predictions.select(ts_text("ts").alias("ts"), "condition")
