"""Shared helpers for the registered queries: table loading, money in cents,
and a small registry that pairs each Spark query with its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``oracle`` is the equivalent DuckDB SQL over the driver views; ``None``
    marks an operator that SQL cannot express (rows-only check).
    """
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def cents(c: str | Column) -> Column:
    """Money as exact integer cents (same rounding in Spark and DuckDB)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col * 100).cast("bigint")


def ts_text(c: str | Column) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss`` text for cross-engine comparison."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
