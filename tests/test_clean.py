"""Hand-worked cases for expressions, cleaning, forward fill, union (FIXTURES D1, D5-D8)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from roadcast.functions import expressions as X
from roadcast.operators import clean as C


def test_d1_travel_time(spark):
    df = spark.createDataFrame([(360.0, 36.0), (360.0, 18.0), (360.0, 72.0), (360.0, 0.0), (360.0, None)],
                               "d double, v double")
    got = [r.t for r in df.select(X.travel_time("d", "v").alias("t")).collect()]
    assert got[:3] == [pytest.approx(36.0), pytest.approx(72.0), pytest.approx(18.0)]
    assert got[3] is None and got[4] is None


def test_d7_hour_24_rolls_over_and_bad_text_is_null(spark):
    df = spark.createDataFrame([("20210101", 24), ("20210101", 10), ("2021x", 10)], "d string, h int")
    got = [r.ts for r in df.select(X.hour_timestamp("d", "h").alias("ts")).collect()]
    assert got[0] == dt.datetime(2021, 1, 2, 0, 0)
    assert got[1] == dt.datetime(2021, 1, 1, 10, 0)
    assert got[2] is None


def test_d6_file_period(spark):
    names = ["2017년 12월 통행속도.csv", "2017년11월 통행속도.csv", "2017년 1월 통행속도.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [tuple(r.p) for r in df.select(X.file_period("n").alias("p")).collect()]
    assert got == [("201712", "csv", dt.date(2017, 12, 1)), ("201711", "csv", dt.date(2017, 11, 1)),
                   ("20171", "csv", dt.date(2017, 1, 1))]


@pytest.mark.parametrize("bucketed", [False, True])
def test_d5_forward_fill(spark, bucketed):
    rows = [(1, i, v) for i, v in enumerate([None, 3.0, None, None, 7.0, None])]
    rows += [(2, i, v) for i, v in enumerate([None, 5.0, None])]
    df = spark.createDataFrame(rows, "station int, t int, v double")
    bucket = (F.col("t") / 2).cast("int") if bucketed else None
    out = C.forward_fill(df, {"v": "f"}, ["station"], ["t"], bucket=bucket)
    got = {(r.station, r.t): r.f for r in out.collect()}
    assert [got[(1, i)] for i in range(6)] == [None, 3.0, 3.0, 3.0, 7.0, 7.0]
    assert [got[(2, i)] for i in range(3)] == [None, 5.0, 5.0]


@pytest.mark.parametrize("pieces", [2, 7, 64])
def test_forward_fill_of_one_series_with_ties_and_null_keys(spark, pieces):
    rng = random.Random(pieces)
    rows = [(rng.choice([None, "s"]), rng.choice([None, *range(30)]), rng.choice([None, None, 1.0, 2.0, 3.0])) for _ in range(300)]
    got = C.forward_fill(spark.createDataFrame(rows, "s string, t int, v double"), {"v": "f"}, ["s"], ["t"], pieces=pieces)

    def want(s, t, v):
        place = lambda x: -1 if x is None else x
        known = [(place(t2), v2) for s2, t2, v2 in rows if s2 == s and v2 is not None and place(t2) <= place(t)]
        return v if v is not None else max(known)[1] if known else None

    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(str((*r, want(*r))) for r in rows)


def test_forward_fill_orders_without_quantiles_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 2.0), ("d", None)], "t string, v double")
    assert sorted((r.t, r.v) for r in C.forward_fill(df, ["v"], [], ["t"]).collect()) == [("a", 1.0), ("b", 1.0), ("c", 2.0), ("d", 2.0)]
    assert C.forward_fill(spark.createDataFrame([], "t timestamp, v double"), ["v"], [], ["t"]).count() == 0


def test_hours_to_long_from_names(spark):
    df = spark.createDataFrame([(1, 10.0, None)], "id int, `10시` double, `~15시` double")
    out = C.hours_to_long(df, ["id"], ["10시", "~15시"]).collect()
    assert sorted((r.hour, r.speed_kmh) for r in out) == [(10, 10.0), (15, None)]


def test_fill_require_nulls(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, 2.0, None)], "a int, b double, s string")
    assert C.null_counts(df).first().asDict() == {"a": 1, "b": 1, "s": 1}
    assert C.require(df, ["a"]).count() == 1
    filled = C.fill_numeric(df, 0).collect()
    assert filled[1].a == 0 and filled[0].b == 0.0 and filled[1].s is None
    assert C.fill_defaults(df, {"b": -1.0, "missing": 3}).collect()[0].b == -1.0


def test_union_all(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    c = spark.createDataFrame([(3,)], "k int")
    got = sorted((r.k, r.v) for r in C.union_all([a, b, c]).collect())
    assert got == [(1, "x"), (2, "y"), (3, None)]
    with pytest.raises(ValueError):
        C.union_all([])


def test_drop_and_slice(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert C.drop_columns(df, ["b", "zz"]).columns == ["a", "c", "d"]
    assert C.project_slice(df, 1, 3).columns == ["b", "c"]
    with pytest.raises(ValueError):
        C.project(df, ["a", "zz"])


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_vals = st.one_of(st.none(), st.floats(min_value=-1e6, max_value=1e6, allow_nan=False))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_vals, _vals), min_size=0, max_size=12),
       st.lists(st.tuples(_vals, _vals), min_size=0, max_size=12))
def test_fill_idempotent_and_union_counts(spark, a_rows, b_rows):
    a = spark.createDataFrame(a_rows, "x double, y double")
    b = spark.createDataFrame(b_rows, "y double, x double")
    once = C.fill_defaults(a, {"x": -1.0})
    twice = C.fill_defaults(once, {"x": -1.0})
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, twice.collect()), key=repr)
    assert once.where("x IS NULL").count() == 0
    u = C.union_all([a, b])
    assert u.count() == len(a_rows) + len(b_rows)
    assert C.null_counts(u).first()["y"] == sum(r[1] is None for r in a_rows) + sum(r[0] is None for r in b_rows)


def test_file_period_ignores_longer_digit_runs(spark):
    df = spark.createDataFrame([("part-00000-0a1b2c3d-c000.csv",), ("20171-3.csv",)], "n string")
    assert [r.p for r in df.select(X.file_period("n")["period"].alias("p")).collect()] == [None, None]
