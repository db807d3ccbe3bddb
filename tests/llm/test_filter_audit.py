"""Filter interaction audit against brute force over documents and orders."""

from collections import defaultdict
from itertools import permutations

import pandas as pd

from roadcast.llm.filter_audit import audit

from .helpers import SF, WORD, docs, odd_rows, table


def brute(rows, marks):
    """rows: (doc_id, text, source); marks: doc_id -> (good, toxic)."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    parts = defaultdict(list)
    for i, t, s in rows:
        t = t or ""
        w = WORD.findall(t)
        bad = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
               "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t),
               "E": i is not None and i > first[t]}
        parts[s or ""].append(({f for f in bad if bad[f]}, *marks.get(i, (0, 0))))
    out = {}
    for part, held in parts.items():
        total = defaultdict(int)
        mine = {}
        for o in map("".join, permutations("ABCDE")):
            alive = list(range(len(held)))
            for step, f in enumerate(o, 1):
                gone = [k for k in alive if f in held[k][0]]
                stay = [k for k in alive if f not in held[k][0]]
                redundant = sum(f in held[k][0] for k in set(range(len(held))) - set(alive))
                mine[part, o, step] = (len(stay), len(gone), redundant, sum(h[0] == {f} for h in held),
                                       sum(held[k][1] for k in gone), sum(held[k][2] for k in gone), f)
                total[f] += len(gone)
                alive = stay
        out.update({k: (*v[:-1], total[v[-1]]) for k, v in mine.items()})
    return out


def got(df):
    f = df.toPandas()
    assert not f.duplicated(["part", "filter_order", "step"]).any()
    return {tuple(r[:3]): tuple(r[3:]) for r in f[["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                                                   "good_lost", "toxic_lost", "shapley"]].itertuples(index=False, name=None)}


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_given_tables(spark):
    d, m = pd.read_parquet(f"{SF}/documents.parquet"), pd.read_parquet(f"{SF}/labels.parquet")
    marks = {i: (q == 1, t == 1) for i, q, t in m[["doc_id", "quality", "toxic"]].itertuples(index=False)}
    want = brute(list(d[["doc_id", "text", "source"]].itertuples(index=False, name=None)), marks)
    assert got(audit(table(spark), table(spark, "labels"))) == want


def test_nulls_ties_repeats_long_texts(spark):
    rows = odd_rows() + [(20, "A" * 300, "en", ""), (21, "a b # c", "en", None), (22, " ".join(map(str, range(250))), "en", "a"),
                         (23, " ".join(map(str, range(250))), "en", "b"), (24, "é" * 40 + "A", "en", "a"), (30, "ab c", "en", "b"),
                         (31, ("wort " * 300_000) + "#", "de", "b")]
    marks = labels(spark, [(20, 1, 0), (20, 0, 1), (6, 1, None), (None, 1, 1), (23, 1, 1), (30, None, None), (3, 0, 0)])
    want = brute([(r[0], r[1], r[3]) for r in rows], {20: (1, 1), 6: (1, 0), 23: (1, 1)})
    assert got(audit(docs(spark, rows), marks)) == want


def test_empty_tables(spark):
    assert audit(docs(spark, [(1, "x")]).limit(0), labels(spark, [])).count() == 0
    assert audit(docs(spark, [(1, "x")]), labels(spark, [])).count() == 600


def test_columns_differing_in_case_only(spark):
    d = docs(spark, [(1, "x"), (2, "x")]).withColumnRenamed("key", "TEXT").withColumnRenamed("id", "Mask")
    assert audit(d, labels(spark, [])).where("step = 1 AND filter_order = 'EABCD' AND removed = 1").count() == 1
