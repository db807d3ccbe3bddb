import random
from collections import defaultdict

import numpy as np

from roadcast.llm.line_chunks import boundaries, digests, line_dedup, windows
from roadcast.llm.queries import QUERIES

from .helpers import SF, docs, odd_rows, table


def lines_of(t):
    ls = (t or "").encode().split(b"\n")
    return ls[:-1] if len(ls) > 1 and ls[-1] == b"" else ls


def brute(rows, least=32):
    """All runs of 2 or more lines and ``least`` bytes that start earlier go; ids are unique."""
    first, out = {}, []
    for i, t in sorted(rows):
        ls = lines_of(t)
        gone = [False] * len(ls)
        for a in range(len(ls)):
            for b in range(a + 2, len(ls) + 1):
                body = b"\n".join(ls[a:b])
                if len(body) >= least:
                    if first.setdefault(body, (i, a)) < (i, a):
                        gone[a:b] = [True] * (b - a)
        tail = len(ls) - 1
        left = b"".join(x + (b"" if k == tail and not (t or "").endswith("\n") else b"\n") for k, x in enumerate(ls) if not gone[k])
        out.append((i, left.decode(), sum(gone)))
    return out


def brute_long(rows, least=32):
    """As ``brute`` for long texts: runs grow by a line as long as they repeat."""
    texts = sorted(rows)
    ls = [lines_of(t) for _, t in texts]
    gone = [[False] * len(x) for x in ls]
    runs, n = [(d, a) for d, x in enumerate(ls) for a in range(len(x))], 2
    while runs:
        at = defaultdict(list)
        for d, a in runs:
            if a + n <= len(ls[d]):
                at[b"\n".join(ls[d][a:a + n]), n].append((d, a))
        runs = []
        for (body, _), places in at.items():
            if len(places) > 1:
                runs += places
                if len(body) >= least:
                    for d, a in sorted(places)[1:]:
                        gone[d][a:a + n] = [True] * n
        n += 1
    out = []
    for (i, t), x, g in zip(texts, ls, gone):
        parts = [line + (b"" if k == len(x) - 1 and not (t or "").endswith("\n") else b"\n") for k, line in enumerate(x) if not g[k]]
        out.append((i, b"".join(parts).decode(), sum(g)))
    return out


def run(df):
    return sorted((r["doc_id"], r["text"], r["n_removed"]) for r in line_dedup(df, runs=True).collect())


def test_short_passages_go_whole(spark):
    rng = random.Random(7)
    passages = [[f"shared {n} {k} {rng.random()}" for k in range(n)] for n in range(2, 11)]
    rows = []
    for i in range(60):
        own = [f"own {i} {k} {rng.random()}" for k in range(6)]
        at = rng.randrange(7)
        rows.append((i, "\n".join(own[:at] + passages[i % 9] + own[at:])))
    got = {i: t for i, t, _ in run(docs(spark, rows))}
    for i, t in rows:
        if i < 9:
            assert got[i] == t
        else:
            assert [x for x in got[i].split("\n") if x] == [x for x in t.split("\n") if x.startswith("own")]


def test_equals_all_runs(spark):
    rng = random.Random(2)
    pool = ["", "", "a", "}", "short line", "a line that alone has more than thirty-two bytes", "middle length one", "é" * 9]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 14)))) for i in range(120)]
    assert run(docs(spark, rows)) == brute(rows)


def test_driver_table_and_query(spark):
    t = table(spark)
    rows = [(r[0], r[1]) for r in t.select("doc_id", "text").collect()]
    seen, again = set(), set()                 # documents that repeat a pair of lines of an earlier one
    for i, text in sorted(rows):
        ls = lines_of(text)
        pairs = {x + b"\n" + y for x, y in zip(ls, ls[1:]) if len(x) + len(y) + 1 >= 32}
        if pairs & seen:
            again.add(i)
        seen |= pairs
    got = {r["doc_id"]: r["n_removed"] for r in QUERIES["op6_line_chunks"](spark, SF).collect()}
    assert again and all(got[i] >= 2 for i in again)


def test_windows_and_odd_rows(spark):
    assert windows(b"") == [] and windows(b"one line of more than thirty-two bytes\n") == []
    assert [w[2] for w in windows(b"\n" * 200)][:1] == [33]
    d = docs(spark, [(r[0], r[1]) for r in odd_rows()])
    assert digests(line_dedup(d, runs=True)).count() == len(odd_rows())
    assert line_dedup(docs(spark, []), runs=True).count() == 0


def test_every_run_holds_a_boundary_of_its_own():
    rng = random.Random(4)
    pool = ["", "", "a", "short", "a line of some length, no. 1", "a line of some length, no. 2", "x" * 50]
    for _ in range(200):
        ls = [rng.choice(pool).encode() for _ in range(rng.randrange(2, 30))]
        at, h = boundaries(b"\n".join(ls))
        n = len(lines_of(b"\n".join(ls).decode()))
        assert all({k, k + 1} & set(at.tolist()) for k in range(n - 1))
        for k in range(n - 1):                     # the run alone chooses a boundary that the text has too
            own = set(boundaries(ls[k] + b"\n" + ls[k + 1] + b"\n")[1].tolist())
            assert own & set(h[(at == k) | (at == k + 1)].tolist())
    assert boundaries(b"")[0].size == boundaries(b"one line\n")[0].size == 0


def test_windows_only_around_boundaries():
    text = b"\n".join(b"line number %d of the text" % k for k in range(40))
    assert windows(text, near=np.array([], dtype=np.int64)) == []
    some = windows(text, near=np.array([20]))
    assert some and set(some) < set(windows(text))
    assert all(s <= text.index(b"line number 20 ") < e for s, e, _, _ in some)


def test_driver_table_equals_all_runs(spark):
    t = table(spark)
    rows = [(r[0], r[1]) for r in t.select("doc_id", "text").collect()]
    assert run(t) == brute_long(rows)


def test_both_brute_forces_agree():
    rng = random.Random(12)
    pool = ["", "", "a", "}", "short line", "a line that alone has more than thirty-two bytes"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 14)))) for i in range(120)]
    assert brute_long(rows) == brute(rows)
