"""Conform-to-latest, lookup with default, latest per key (FIXTURES D2, D3)."""

import datetime as dt

from roadcast.operators import lookup as L
from roadcast.plans import jobs as J


def test_d2_conform_to_latest(spark):
    rows = [("2021-11", 1, "L1", "A_old", "B_old"), ("2021-11", 2, "L9", "X", "Y"),
            ("2021-12", 3, "L1", "A", "B"), ("2021-12", 4, "L2", "B", "C"), ("2021-11", 5, "L2", "B", "C")]
    df = spark.createDataFrame(rows, "period string, n int, link string, f string, t string")
    out = L.conform_to_latest(df, "link", ["f", "t"], "period", ["n"])
    got = sorted((r.n, r.link, r.f, r.t) for r in out.collect())
    assert got == [(1, "L1", "A", "B"), (3, "L1", "A", "B"), (4, "L2", "B", "C"), (5, "L2", "B", "C")]


def test_d3_lookup_default_never_multiplies(spark):
    facts = spark.createDataFrame([(1, dt.datetime(2021, 1, 1, 10)), (2, dt.datetime(2021, 1, 1, 15)),
                                   (3, None)], "id int, ts timestamp")
    cond = spark.createDataFrame([(dt.datetime(2021, 1, 1, 10), 2, "s1"), (dt.datetime(2021, 1, 1, 10), 5, "s2")],
                                 "ts timestamp, condition int, station string")
    out = J.label_traffic(facts, cond, order=["station"])
    got = sorted((r.id, r.condition) for r in out.collect())
    assert got == [(1, 5), (2, -1), (3, -1)]


def test_latest_per_key_and_semi(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, o int, v string")
    got = sorted((r.k, r.o, r.v) for r in L.latest_per_key(df, "k", ["o"]).collect())
    assert got == [("a", 2, "y"), ("b", 1, "z")]
    first = sorted((r.k, r.v) for r in L.latest_per_key(df, "k", ["o"], latest=False).collect())
    assert first == [("a", "x"), ("b", "z")]
    dim = spark.createDataFrame([("a",)], "k string")
    assert [r.k for r in L.keep_known(df, dim, "k").collect()] == ["a", "a"]


def test_conform_with_a_hot_link(spark):
    # one link holds most rows; the answer must not depend on it
    rows = [("2021-12", i, "HOT", f"F{i % 7}", f"T{i % 5}") for i in range(3000)]
    rows += [("2021-11", 5000 + i, f"L{i}", "X", "Y") for i in range(100)]
    rows += [("2021-12", 9000, "L1", "A", "B")]
    df = spark.createDataFrame(rows, "period string, n int, link string, f string, t string")
    out = L.conform_to_latest(df, "link", ["f", "t"], "period", ["n"])
    got = {(r.link, r.f, r.t) for r in out.collect()}
    assert got == {("HOT", "F3", "T4"), ("L1", "A", "B")}     # latest HOT row: n=2999 -> F3, T4
    assert out.count() == 3000 + 2                             # L1 has an old and a new row
