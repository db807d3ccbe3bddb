"""Collects every registered query and oracle from the check modules."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from . import common
from ..session import apply_conventions


@functools.cache
def _load_all() -> None:
    # importing a module registers its queries
    from . import graph_checks, io_checks, ml_checks, pipe_checks, run_checks, table_checks  # noqa: F401


def _wrap(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_conventions(spark)
        return fn(spark, sf_dir)
    return run


def queries():
    _load_all()
    return {k: _wrap(v) for k, v in common.QUERIES.items()}


def oracle_sql():
    _load_all()
    return dict(common.ORACLES)
