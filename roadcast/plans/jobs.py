"""End-to-end jobs (Q1-Q6): traffic preparation, condition clustering,
labelling, condition report, scenario routing, and a full run with reuse of
prepared datasets.  Each job is a composition of the operators; none
collects data to the driver (only model parameters and one-row summaries)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as SC
from ..functions.expressions import hour_timestamp, travel_time
from ..operators import clean as C
from ..operators import cluster as M
from ..operators import graph as G
from ..operators import lookup as L
from ..operators import report as R
from ..sources import files as S

FACT_COLUMNS = [f.name for f in SC.TRAFFIC_FACT.fields]


# ---------------------------------------------------------------- Q1
def prepare_traffic(wide: DataFrame, hour_cols: Sequence[str] | dict = SC.SPEED_HOUR_COLUMNS,
                    period: str = "period", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Wide speed rows -> travel-time facts.

    ``wide``: date (yyyyMMdd integer or text), link_id, from_node, to_node,
    distance_m, the hour columns, ``period`` (month of the source file) and
    optional ``tiebreak`` columns that make (date, *tiebreak) unique per link.
    Links are conformed to the newest period (names overwritten, unknown
    links dropped), hours go long in one pass, then travel time and the
    timestamp of the hour; rows without a travel time are dropped.
    """
    order = ["date", *tiebreak]
    conformed = L.conform_to_latest(wide, "link_id", ["from_node", "to_node"], period, order)
    ids = ["date", "link_id", "from_node", "to_node", "distance_m"]
    long = C.hours_to_long(conformed, ids, hour_cols, "hour", "speed_kmh")
    facts = long.select(
        F.try_to_date(F.col("date").cast("string"), "yyyyMMdd").alias("date"),
        F.col("link_id").cast("bigint").alias("link_id"), "from_node", "to_node",
        F.col("distance_m").cast("double").alias("distance_m"),
        F.col("speed_kmh").cast("double").alias("speed_kmh"), "hour",
        travel_time("distance_m", "speed_kmh").alias("travel_s"),
        hour_timestamp("date", "hour").alias("ts"))
    return facts.where(F.col("travel_s").isNotNull())


# ---------------------------------------------------------------- Q2
@dataclass
class ConditionModel:
    predictions: DataFrame          # observations + condition (reads the persisted features)
    silhouette: float
    centers: list
    k: int
    spec: M.PrepSpec
    features: DataFrame | None = None

    def release(self) -> None:
        """Drop the persisted feature frame once the predictions are written."""
        if self.features is not None:
            self.features.unpersist()
            self.features = None

    def meta(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            S.cluster_meta(self.silhouette, self.k, self.spec.name, self.spec.features),
            S.CLUSTER_META_SCHEMA)


def prepare_conditions(observations: DataFrame, spec: M.PrepSpec, k: int, seed: int = 42,
                       bucket: Column | None = None) -> ConditionModel:
    """Clean, assemble, fit k-means and label every observation.

    The forward fill (if the spec has one) runs per (series, day) with a
    carry-in from earlier days, so a single long series is not one task.
    The cleaned features stay persisted (memory, spilling to disk) for the
    fit, the silhouette and the caller's use of ``predictions``; call
    ``release()`` after writing them.
    """
    if bucket is None and spec.ffill:
        bucket = F.date_trunc("day", F.col(spec.order[0]))
    feats = M.prep_and_assemble(observations, spec, "features", bucket).persist(
        StorageLevel.MEMORY_AND_DISK)
    model = M.fit_conditions(feats, k, "features", seed)
    pred = model.transform(feats)
    sil = M.silhouette(pred, "features", "condition")
    return ConditionModel(pred.drop("features"), sil,
                          [list(map(float, c)) for c in model.clusterCenters()], k, spec, feats)


# ---------------------------------------------------------------- Q3
def label_traffic(facts: DataFrame, conditions: DataFrame, default: int = -1,
                  order: Sequence[str] = ()) -> DataFrame:
    """Condition of the hour of every fact, ``default`` when unknown.

    Several observations of one hour (stations) are reduced to one, the
    latest by ``order`` -- facts are never multiplied.
    """
    dim = conditions.select(F.col("ts").cast("timestamp").alias("ts"),
                            F.col("condition").cast("int").alias("condition"), *order)
    return L.lookup_default(facts, dim, "ts", "condition", default,
                            order=list(order) if order else None)


# ---------------------------------------------------------------- Q4
def condition_report(conditions: DataFrame, label: str = "condition",
                     cols: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(summary, profile): one-row summary and the per-condition profile."""
    return R.cluster_summary(conditions, label), R.cluster_profile(conditions, label, cols)


def stored_report(spark: SparkSession, conditions_path: str, meta_path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(meta, summary, profile) of a stored clustering, as its sidecar says.

    The sidecar's column list is taken from the observations; its mode decides
    the profile: the compact mode gives the means of its three features with
    the count of every condition, in the order of the conditions, the full
    mode the means of all listed columns.
    """
    meta = S.read_cluster_meta(spark, meta_path)
    mode, columns = meta.agg(F.max("mode"), F.max("columns")).first()
    stored = S.read_prepared(spark, conditions_path).select(*columns, "condition")
    summary, profile = condition_report(stored, cols=columns)
    means = [c for c in profile.columns if c not in ("condition", "n", "count")]
    if mode == SC.FULL_MODE.name:
        profile = profile.select("condition", *means)
    return meta, summary, profile


# ---------------------------------------------------------------- Q5
def scenario_edges(facts: DataFrame, scenario_cols: Sequence[str] = ("condition", "hour")) -> DataFrame:
    """Mean travel time per (scenario, link, from, to) as directed edges."""
    by = [*scenario_cols, "link_id", "from_node", "to_node"]
    costs = R.edge_costs(facts, by, "travel_s")
    edges, _ = G.build_graph(costs, scenario_cols)
    return edges


def routes_by_scenario(facts: DataFrame, pairs: DataFrame,
                       scenario_cols: Sequence[str] = ("condition", "hour"),
                       vertices: str = "both", **kw) -> DataFrame:
    """Least-time routes for (scenario, src, dst) requests, every scenario at once."""
    edges = scenario_edges(facts, scenario_cols)
    return G.route(edges, pairs, scenario_cols, vertices=vertices, **kw)


def route_for(facts: DataFrame, condition: int, hour: int, src, dst, **kw) -> DataFrame:
    """The reference's single question: one (condition, hour), one pair."""
    one = C.for_scenario(facts, {"condition": condition, "hour": hour})
    spark = facts.sparkSession
    pairs = spark.createDataFrame([(condition, hour, src, dst)],
                                  ["condition", "hour", "src", "dst"]).select(
        F.col("condition").cast("int"), F.col("hour").cast("int"), "src", "dst")
    return routes_by_scenario(one, pairs, **kw)


# ---------------------------------------------------------------- Q6
@dataclass
class RunConfig:
    """Paths and parameters of a full run (replaces the console menus)."""
    traffic_path: str                      # prepared traffic facts
    conditions_path: str                   # labelled observations
    labelled_path: str                     # facts + condition
    meta_path: str                         # clustering summary
    speed_layouts: dict = field(default_factory=dict)   # layout -> paths of monthly CSVs
    speed_name_level: int = 0              # period from the file name (0) or its folder (1)
    weather_paths: Sequence[str] = ()
    encoding: str = "cp949"
    spec: M.PrepSpec = SC.COMPACT_MODE
    k: int = 4
    seed: int = 42
    refresh: bool | Sequence[str] = False   # all, or names out of traffic, conditions, labelled
    station_order: Sequence[str] = ("station",)   # of several observations of an hour the last by these columns counts


def _rename(df: DataFrame, mapping: dict) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def input_marks(spark: SparkSession, cfg: RunConfig) -> dict[str, str | None]:
    """Fingerprints of what each prepared dataset is built from; None where inputs are missing."""
    def mark(paths, *parameters):
        try:
            return S.fingerprint(spark, paths, *parameters) if paths else None
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    speed = [p for paths in cfg.speed_layouts.values() for p in paths]
    marks = {"traffic": mark(speed, {k: sorted(v) for k, v in cfg.speed_layouts.items()}, cfg.speed_name_level, cfg.encoding,
                             SC.SPEED_WIDE.simpleString()),
             "conditions": mark(list(cfg.weather_paths), cfg.encoding, cfg.spec, cfg.k, cfg.seed, tuple(cfg.station_order))}
    both = [marks["traffic"], marks["conditions"]]
    marks["labelled"] = None if None in both else S.fingerprint(spark, [], *both)
    return marks


def prepare_datasets(spark: SparkSession, cfg: RunConfig, report: dict | None = None) -> DataFrame:
    """Reuse the prepared datasets when complete, else rebuild and write them.

    ``cfg.refresh`` asks for all of them or for some by name.  Each dataset is
    published with a fingerprint of what it was built from -- the input files
    and parameters of traffic and conditions, both of these for the labelled
    set -- and is built anew when that has changed: another monthly file rebuilds
    the traffic, another ``k`` the conditions, either of them the labelled set.
    Input files that are gone, or not named, cannot have changed.  A current
    labelled set is used alone.  Returns the labelled facts (read back from
    ``cfg.labelled_path``).  ``report["built"]`` lists the datasets that had to be
    (re)built.
    """
    rebuilt = report.setdefault("built", []) if report is not None else []
    names = ("traffic", "conditions", "labelled")
    ask = set(names if cfg.refresh is True else cfg.refresh or ())
    if ask - set(names):
        raise ValueError(f"unknown datasets {sorted(ask - set(names))}")
    marks = input_marks(spark, cfg)
    if not ask and all(S.is_current(spark, p, m) for p, m in (
            (cfg.labelled_path, marks["labelled"]), (cfg.meta_path, None))):
        return S.read_prepared(spark, cfg.labelled_path)

    def build_traffic():
        rebuilt.append("traffic")
        ask.add("labelled")
        wide = S.read_monthly(spark, cfg.speed_layouts, SC.SPEED_WIDE, cfg.encoding,
                              name_level=cfg.speed_name_level)
        return prepare_traffic(_rename(wide, SC.SPEED_COLUMNS))

    built = []

    def build_conditions():
        rebuilt.append("conditions")
        ask.add("labelled")
        parts = [_rename(part, SC.WEATHER_COLUMNS)
                 for part in S.read_by_header(spark, list(cfg.weather_paths), cfg.encoding)]
        obs = C.union_all([part.select(*[F.col(c).try_cast("double").alias(c) if c != "ts"
                                         else F.try_to_timestamp(F.col(c)).alias(c)
                                         for c in part.columns if "QC" not in c]) for part in parts])
        kept = tuple(c for c in cfg.station_order if c in obs.columns)     # not features, but they order the stations
        spec = replace(cfg.spec, drop=tuple(c for c in cfg.spec.drop if c not in kept),
                       select=tuple(dict.fromkeys((*cfg.spec.select, *kept))) if cfg.spec.select else cfg.spec.select)
        model = prepare_conditions(obs, spec, cfg.k, cfg.seed)
        built.append(model)
        return model.predictions

    traffic = S.materialize(spark, cfg.traffic_path, build_traffic, "traffic" in ask,
                            partition_by=["hour"], manifest=marks["traffic"])
    conditions = S.materialize(spark, cfg.conditions_path, build_conditions,
                               "conditions" in ask or not S.is_complete(spark, cfg.meta_path), manifest=marks["conditions"])
    for model in built:          # written and re-read: the summary follows, the cached features can go
        S.write_cluster_meta(model.meta(spark), cfg.meta_path)
        model.release()

    def build_labelled():
        rebuilt.append("labelled")
        order = [c for c in cfg.station_order if c in conditions.columns]
        return label_traffic(traffic, conditions, order=order)

    return S.materialize(spark, cfg.labelled_path, build_labelled, "labelled" in ask,
                         partition_by=["hour"], manifest=marks["labelled"])


def run(spark: SparkSession, cfg: RunConfig,
        pairs: DataFrame | Callable[[DataFrame], DataFrame],
        report: dict | None = None) -> DataFrame:
    """Full run: prepared datasets (reused or rebuilt), then the routes.

    ``pairs`` are the (condition, hour, src, dst) requests, or a function of
    the labelled facts that derives them.  ``report`` gets, besides ``built``, the
    stored clustering summary (``meta``) and what ``stored_report`` makes of it
    (``summary``, ``profile``).
    """
    labelled = prepare_datasets(spark, cfg, report)
    if report is not None:
        report.update(zip(("meta", "summary", "profile"), stored_report(spark, cfg.conditions_path, cfg.meta_path)))
    requests = pairs(labelled) if callable(pairs) else pairs
    return routes_by_scenario(labelled, requests)
