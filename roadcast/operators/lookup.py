"""Dimension operators: semi-join membership, latest row per key, conform to
the newest dimension, lookup with default (F3, A6, J1, J2, J5).

None of these collects keys to the driver or ships a dict inside a UDF: the
dimension stays a DataFrame and is joined.  Joins carry no broadcast hint --
the dimension (links, timestamps) grows with the data; adaptive execution
turns a join into a broadcast when the measured size allows it and splits
skewed fact partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def keep_known(df: DataFrame, dim: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``dim`` (left semi join, no collect)."""
    k = _keys(key)
    return df.join(dim.select(*k), k, "left_semi")


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column],
                   latest: bool = True) -> DataFrame:
    """One row per key: the row with the largest (or smallest) ``order``.

    ``order`` should be unique per key (add tie-break columns).  Done as a
    ``max``/``min`` of a struct, so it is a partial aggregation: a key with a
    huge number of rows is pre-reduced on every map task instead of being
    sorted in one window task.
    """
    k = _keys(key)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    rest = [c for c in df.columns if c not in k]
    packed = F.struct(F.struct(*order_cols).alias("o"), F.struct(*rest).alias("r"))
    agg = F.max if latest else F.min
    return df.groupBy(*k).agg(agg(packed).alias("_m")).select(*k, "_m.r.*")


def newest_rows(df: DataFrame, period: str) -> DataFrame:
    """Rows of the newest ``period`` (equi-join with the one-row maximum)."""
    newest = df.agg(F.max(period).alias("_newest"))
    return df.join(newest, F.col(period) == F.col("_newest")).drop("_newest")


def _one_row_per_key(df: DataFrame, name: str) -> DataFrame:
    """Write a per-key summary once to the shared folder and read it back, so
    its two consumers do not each re-evaluate the facts below it."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keys_in_newest(df: DataFrame, key: str | Sequence[str], period: str) -> DataFrame:
    """Keys that occur in the newest ``period`` of ``df``.

    One partial aggregation (newest period per key, written once as a small
    table); the overall newest period is then taken over that per-key table,
    not over the facts.  (Runs one job when called.)
    """
    k = _keys(key)
    per_key = _one_row_per_key(df.groupBy(*k).agg(F.max(period).alias("_p")), "newest-keys")
    return newest_rows(per_key, "_p").select(*k)


def conform_to_latest(df: DataFrame, key: str | Sequence[str], attrs: Sequence[str],
                      period: str, order: Sequence[str | Column]) -> DataFrame:
    """Conform facts to the newest dimension.

    The dimension is the newest ``period`` of ``df`` itself: one row per key
    (the latest by ``order``), giving ``attrs``.  Facts of keys absent from the
    newest period are dropped; ``attrs`` of the remaining facts are replaced.

    The facts are read for the newest period (one column), for its rows, which
    alone are shuffled to find the latest row per key, and for the join; a frame
    that is costly to evaluate is best written before.
    """
    k = _keys(key)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    packed = F.struct(F.struct(*order_cols).alias("o"), F.struct(*[F.col(a) for a in attrs]).alias("a"))
    dim = newest_rows(df, period).groupBy(*k).agg(F.max(packed).alias("_m"))
    return df.drop(*attrs).join(dim.select(*k, *[F.col(f"_m.a.{a}").alias(a) for a in attrs]), k)


def lookup_default(df: DataFrame, dim: DataFrame, on: str | Sequence[str], value: str,
                   default: object = -1, order: Sequence[str | Column] | None = None,
                   alias: str | None = None) -> DataFrame:
    """Attach ``dim.value`` by key, ``default`` when absent.

    Duplicate keys in ``dim`` never multiply facts: they are reduced to one
    row first (the latest by ``order``; without an order the largest value).
    """
    k = _keys(on)
    if order is not None:
        d = latest_per_key(dim.select(*k, value, *[o for o in order if isinstance(o, str)
                                                   and o not in k and o != value]), k, order)
        d = d.select(*k, value)
    else:
        d = dim.groupBy(*k).agg(F.max(value).alias(value))
    out_name = alias or value
    joined = df.join(d.withColumnRenamed(value, "_lk_value"), k, "left")
    return joined.withColumn(out_name, F.coalesce(F.col("_lk_value"), F.lit(default))).drop("_lk_value")
