"""Aggregations and reports (A1-A8, O1-O3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .clean import numeric_columns


def edge_costs(df: DataFrame, by: Sequence[str], value: str = "travel_s",
               alias: str | None = None) -> DataFrame:
    """Mean of ``value`` per group (partial + final aggregation)."""
    return df.groupBy(*by).agg(F.avg(value).alias(alias or value))


def cluster_profile(df: DataFrame, label: str = "condition", cols: Sequence[str] | None = None,
                    count_alias: str = "n", prefix: str = "avg_") -> DataFrame:
    """Per-label profile, ordered by label.

    With ``cols``: mean of each plus the group size (compact report).
    Without: mean of every numeric column except the label itself.
    """
    if cols is None:
        cols = [c for c in numeric_columns(df) if c != label]
        aggs = [F.avg(c).alias(f"{prefix}{c}") for c in cols]
    else:
        aggs = [F.avg(c).alias(f"{prefix}{c}") for c in cols] + [F.count(label).alias(count_alias)]
    return df.groupBy(label).agg(*aggs).orderBy(label)


def cluster_summary(df: DataFrame, label: str = "condition") -> DataFrame:
    """Largest label (what the reference printed as the cluster count), the
    true number of labels, and rows."""
    return df.agg(F.max(label).alias("max_label"), F.count_distinct(label).alias("n_labels"),
                  F.count(F.lit(1)).alias("n_rows"))


def argmin(df: DataFrame, by: Sequence[str], order: Sequence[str | Column],
           carry: Sequence[str] = ()) -> DataFrame:
    """Row with the smallest ``order`` per group, as min(struct) (partial agg)."""
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    m = F.min(F.struct(F.struct(*order_cols).alias("o"),
                       F.struct(*[F.col(c) for c in carry]).alias("r"))).alias("_m")
    sel = [*by, "_m.o.*"] + (["_m.r.*"] if carry else [])
    return df.groupBy(*by).agg(m).select(*sel)


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int = 1,
                  rank: str = "rank") -> DataFrame:
    """The first ``n`` rows per group under ``order`` (a unique order), ranked.

    A plain window: Spark limits every group to ``n`` rows in each map task
    before the shuffle (``WindowGroupLimit``), so a hot group is not one task.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def row_counts(frames: Mapping[str, DataFrame], name: str = "table") -> DataFrame:
    """One row per frame: (name, rows) -- all counted in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(k).alias(name), "rows")
             for k, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
