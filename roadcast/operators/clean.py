"""Projection, reshaping, null handling, forward fill and union (P*, F*, W1, U1)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


# ---------------------------------------------------------------- P1 / P2 / P4
def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Select by name; a missing name is an error (the scan reads only these)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(*cols)


def project_slice(df: DataFrame, start: int, stop: int | None = None) -> DataFrame:
    """Select columns by position, Python slice semantics."""
    return df.select(*df.columns[start:stop])


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop by name; names that are not present are ignored."""
    return df.drop(*[c for c in cols if c in df.columns])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


# ---------------------------------------------------------------- P7
def hours_to_long(df: DataFrame, ids: Sequence[str], hour_cols: Mapping[str, int] | Sequence[str],
                  hour: str = "hour", value: str = "speed_kmh") -> DataFrame:
    """Wide -> long on hour columns in one pass (``Expand``), not a union of scans.

    ``hour_cols`` maps column name -> hour label; a plain list takes the hour
    from the digits of each name (``10시`` -> 10, ``~15시`` -> 15).  Rows with
    a null value are kept (callers drop them after computing on them).
    """
    if not isinstance(hour_cols, Mapping):
        hour_cols = {c: int("".join(ch for ch in c if ch.isdigit())) for c in hour_cols}
    names = list(hour_cols)
    long = df.unpivot(list(ids), names, "_hour_col", value)
    label = F.col("_hour_col")
    expr = None
    for name, h in hour_cols.items():
        expr = (F.when(label == name, F.lit(h)) if expr is None
                else expr.when(label == name, F.lit(h)))
    return long.select(*ids, expr.cast("int").alias(hour), value)


# ---------------------------------------------------------------- F4 / F5 / F6
def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``cols`` (one filter, not one per column)."""
    return df.na.drop(how="any", subset=list(cols))


def fill_defaults(df: DataFrame, mapping: Mapping[str, object]) -> DataFrame:
    """Per-column constants for nulls; absent columns are ignored."""
    present = {c: v for c, v in mapping.items() if c in df.columns}
    return df.na.fill(present) if present else df


def fill_numeric(df: DataFrame, value: float | int = 0) -> DataFrame:
    """Fill nulls of every numeric column with ``value``; strings untouched."""
    return df.fillna(value, subset=numeric_columns(df))


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of nulls in each column (same column names)."""
    return df.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def for_scenario(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Keep rows of one scenario (``col = value`` for every item), typed literals."""
    cond = None
    for c, v in values.items():
        dtype = df.schema[c].dataType
        term = F.col(c) == F.lit(v).cast(dtype)
        cond = term if cond is None else cond & term
    return df.where(cond) if cond is not None else df


# ---------------------------------------------------------------- W1
FILL_PIECES = 64


def _pieces(df: DataFrame, at: Column, pieces: int) -> Column | None:
    """Number of the quantile range that ``at`` lies in, or None where its type
    has no quantiles.  One pass; ``pieces - 1`` values come to the driver."""
    kind = df.select(at).schema[0].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return None
    cuts = df.agg(F.percentile_approx(at, [i / pieces for i in range(1, pieces)], 100 * pieces)).first()[0]
    out = F.lit(0)
    for c in sorted(set(cuts or [])):
        out = out + F.when(at > F.lit(c).cast(kind), 1).otherwise(0)
    return out


def forward_fill(df: DataFrame, cols: Sequence[str] | Mapping[str, str], partition: Sequence[str],
                 order: Sequence[str | Column], bucket: Column | None = None,
                 pieces: int = FILL_PIECES) -> DataFrame:
    """Replace nulls by the last non-null value so far in the series.

    ``cols``: list (fill in place) or {source: new column}.  Rows of equal
    ``order`` see each other: a null takes the greatest of the values that
    stand at the latest place up to its own; a value stays as it is.  Null
    places come first.

    Every series is split along ``order``; the fill runs per (series, piece)
    and the value carried into each piece is taken from a per-(series, piece)
    summary, so one very long series does not become one task.  ``bucket`` is
    an expression monotone in ``order`` that gives the pieces (e.g. the day of
    the timestamp).  Without it they are ``pieces`` quantile ranges of the
    first order column, found by an extra pass; an order that has no quantiles
    (text) leaves each series whole.
    """
    mapping = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    part = list(partition)
    if bucket is None:
        bucket = _pieces(df, order_cols[0], pieces)
    if bucket is None:
        bucket = F.lit(0)

    # a value with its place; the greatest one so far is the last one
    place = [o.alias(f"o{i}") for i, o in enumerate(order_cols)]
    seen = {i: F.when(F.col(src).isNotNull(), F.struct(*place, F.col(src).alias("v"))) for i, src in enumerate(mapping)}
    # phase 1: fill inside each (series, piece)
    b = df.withColumn("_ff_bucket", bucket)
    w_in = (Window.partitionBy(*part, "_ff_bucket").orderBy(*order_cols)
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    filled = b.withColumns({f"_ff_in_{i}": F.coalesce(F.col(src), F.max(seen[i]).over(w_in)["v"])
                            for i, src in enumerate(mapping)})
    # phase 2: last non-null value of each (series, piece) -- partial aggregate
    summary = b.groupBy(*part, "_ff_bucket").agg(*[F.max(c)["v"].alias(f"_ff_last_{i}") for i, c in seen.items()])
    # carry-in: last non-null over earlier pieces (one row per piece, small)
    w_prev = (Window.partitionBy(*part).orderBy("_ff_bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = summary.select(*[F.col(c).alias(f"_ff_key_{i}") for i, c in enumerate([*part, "_ff_bucket"])], *[
        F.last(f"_ff_last_{i}", ignorenulls=True).over(w_prev).alias(f"_ff_carry_{i}")
        for i in range(len(mapping))])
    same = [F.col(c).eqNullSafe(F.col(f"_ff_key_{i}")) for i, c in enumerate([*part, "_ff_bucket"])]
    joined = filled.join(carry, same, "left")
    out = joined.withColumns({new: F.coalesce(F.col(f"_ff_in_{i}"), F.col(f"_ff_carry_{i}"))
                              for i, new in enumerate(mapping.values())})
    helper = [c for c in out.columns if c.startswith("_ff_")]
    return out.drop(*helper)


# ---------------------------------------------------------------- U1
def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name (missing columns become null); empty list is an error."""
    dfs = list(dfs)
    if not dfs:
        raise ValueError("union_all needs at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
