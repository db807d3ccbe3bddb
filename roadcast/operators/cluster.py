"""Condition clustering (M1-M7): feature preparation, k-means, assignment,
silhouette, k sweep.  Spark ML does the fitting and evaluation; the cleaning
chain is a declarative spec of built-in DataFrame operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import clean as C


# ---------------------------------------------------------------- M1
def assemble(df: DataFrame, cols: Sequence[str], output: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """Numeric columns -> one vector column (a null fails the job by default)."""
    va = VectorAssembler(inputCols=list(cols), outputCol=output, handleInvalid=handle_invalid)
    return va.transform(df)


def features_from_array(df: DataFrame, array_col: str, output: str = "features") -> DataFrame:
    return df.withColumn(output, array_to_vector(F.col(array_col)))


def features_to_array(col: str = "features") -> Column:
    return vector_to_array(F.col(col))


# ---------------------------------------------------------------- M2 / M3
def fit_conditions(df: DataFrame, k: int, features: str = "features", seed: int = 42,
                   max_iter: int = 20, prediction: str = "condition") -> KMeansModel:
    """Fit k-means (k-means|| init, euclidean).  The seed is explicit so a
    rerun gives the same kinds; k must be at least 2."""
    if k < 2:
        raise ValueError(f"k must be >= 2, got {k}")
    km = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=features, predictionCol=prediction)
    return km.fit(df)


def assign_condition(df: DataFrame, centers: Sequence[Sequence[float]], cols: Sequence[str],
                     output: str = "condition") -> DataFrame:
    """Label each row with its nearest centre (squared euclidean; ties -> lower label).

    ``centers`` are k model parameters (``KMeansModel.clusterCenters()``),
    inlined as a literal array, so the assignment is one projection: no join
    between points and centres and no Python in the row path.
    """
    x = F.array(*[F.col(c).cast("double") for c in cols])
    cs = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centers])
    dists = F.transform(cs, lambda c: F.aggregate(
        F.zip_with(c, x, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v))
    return df.withColumn(output, (F.array_position(dists, F.array_min(dists)) - 1).cast("int"))


# ---------------------------------------------------------------- M4 / M7
def silhouette(df: DataFrame, features: str = "features", prediction: str = "condition") -> float:
    """Mean silhouette, squared euclidean distance (Spark ML evaluator)."""
    ev = ClusteringEvaluator(featuresCol=features, predictionCol=prediction,
                             metricName="silhouette", distanceMeasure="squaredEuclidean")
    return float(ev.evaluate(df))


def sweep_k(df: DataFrame, ks: Sequence[int], features: str = "features", seed: int = 42) -> DataFrame:
    """(k, silhouette, cost) for every k, on one persisted feature frame."""
    data = df.select(features).persist()
    try:
        rows = []
        for k in ks:
            model = fit_conditions(data, k, features, seed)
            pred = model.transform(data)
            rows.append((int(k), silhouette(pred, features), float(model.summary.trainingCost)))
    finally:
        data.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double, cost double")


# ---------------------------------------------------------------- M5 / M6
@dataclass(frozen=True)
class PrepSpec:
    """Declarative cleaning chain for condition observations.

    Steps in order: keep ``select`` (if given) or drop ``drop``; fill
    ``fill`` constants; require ``require``; fill every remaining numeric
    null with ``fill_numeric`` (if given); forward-fill
    ``ffill`` {source: new column} per ``series`` ordered by ``order``;
    require ``require_after``; ``features`` are the model inputs.
    """
    features: tuple[str, ...]
    select: tuple[str, ...] | None = None
    drop: tuple[str, ...] = ()
    fill: Mapping[str, float] = field(default_factory=dict)
    fill_numeric: float | None = None
    require: tuple[str, ...] = ()
    ffill: Mapping[str, str] = field(default_factory=dict)
    require_after: tuple[str, ...] = ()
    series: tuple[str, ...] = ()
    order: tuple[str, ...] = ("ts",)
    name: str = "custom"


def prep_conditions(df: DataFrame, spec: PrepSpec, bucket: Column | None = None) -> DataFrame:
    """Apply a :class:`PrepSpec` (without assembling)."""
    out = C.project(df, list(spec.select)) if spec.select else C.drop_columns(df, spec.drop)
    out = C.fill_defaults(out, spec.fill)
    if spec.require:
        out = C.require(out, spec.require)
    if spec.fill_numeric is not None:
        out = C.fill_numeric(out, spec.fill_numeric)
    if spec.ffill:
        out = C.forward_fill(out, dict(spec.ffill), list(spec.series), list(spec.order), bucket=bucket)
    if spec.require_after:
        out = C.require(out, spec.require_after)
    return out


def prep_and_assemble(df: DataFrame, spec: PrepSpec, output: str = "features",
                      bucket: Column | None = None) -> DataFrame:
    return assemble(prep_conditions(df, spec, bucket), spec.features, output)
