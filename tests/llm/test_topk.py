import math

import numpy as np
import pytest

from roadcast.llm.topk import CoverTree, bound, topk

from .helpers import table


def brute(rows, k=5, every=50):
    good = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        good[i] = np.array([math.floor(256 * float(x)) for x in v], dtype=np.int64)
    out = []
    for q in good:
        if q % every == 0:
            s = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q)[:k]
            out += [(q, r + 1, i, -score) for r, (score, i) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 60])
def test_driver_table(spark, block):
    t = table(spark, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in t.collect()]
    got = topk(t, centres=12, block=block)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_copies_ties_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 6)).astype(float)
    rows = [(i, list(map(float, base[0] if i % 3 == 0 else base[i % 40]))) for i in range(300)]
    rows += [(300, None), (301, []), (302, [1.0, None] + [0.0] * 4), (303, [float("nan")] + [0.0] * 5),
             (350, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (7, rows[7][1])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, node int, ids string")
    assert sorted(tuple(r) for r in topk(df, centres=5, block=50).collect()) == brute(rows)
    assert topk(df.limit(0)).count() == 0
    assert [tuple(r) for r in topk(df.where("vec_id in (0, 1)")).collect()] == brute(rows[:2])


def test_tree_radii_cover_and_bounds_hold():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(700, 8)), rng.normal(size=(500, 8)) + 1

    def check(t, pts):
        d = np.sqrt(((pts[t.at] - t.centre) ** 2).sum(axis=1))
        assert d.max() <= t.radius + 1e-9
        if t.children:
            assert sorted(np.concatenate([c.at for c in t.children])) == sorted(t.at)
            for c in t.children:
                check(c, pts)
    a, b = CoverTree(x, np.arange(700)), CoverTree(y, np.arange(500))
    check(a, x)
    check(b, y)
    for p in [a, *a.children]:
        for q in [b, *b.children]:
            assert (x[p.at] @ y[q.at].T).max() <= bound(p, q)
