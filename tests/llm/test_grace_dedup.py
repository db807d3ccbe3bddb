import hashlib
import random
import re

import pytest

from roadcast.llm.grace_dedup import OpenTable, grace_dedup, resolve

from .helpers import docs, odd_rows, table


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        g = groups[norm(t)]
        keep = min((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("budget", [48 << 20, 3000])
def test_matches_brute_force(spark, budget):
    t = table(spark).select("doc_id", "text").collect()
    rows = [(r[0], r[1]) for r in t] + [(1000 + r[0], (r[1] or "") + "  ") for r in t]
    got = grace_dedup(docs(spark, rows).repartition(5), table_bytes=budget).collect()
    assert sorted(((r[0], r[1], r[2], r[4]) for r in got), key=str) == expected(rows)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({norm(t) for _, t in rows})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    got = grace_dedup(docs(spark, odd_rows())).collect()
    assert sorted(((r[0], r[1], r[2], r[4]) for r in got), key=str) == expected(rows)
    assert sum(r["kept"] for r in got) == len({norm(t) for _, t in rows})


def test_empty_table(spark):
    assert grace_dedup(docs(spark, [])).count() == 0


def test_equal_hashes_still_compare_content(tmp_path):
    rng = random.Random(3)
    records = [(k, rng.choice([5, 5, 9]), bytes([rng.randrange(4)]) * rng.randrange(1, 9)) for k in range(400)]
    got = dict(resolve(iter(records), str(tmp_path), budget=900))
    by = {k: (h, c) for k, h, c in records}
    assert len(got) == 400
    assert all(by[k] == by[lead] for k, lead in got.items())
    assert len(set(got.values())) == len(set(by.values()))


def test_open_table_grows_and_refuses():
    t = OpenTable(10**9)
    assert all(t.add(i % 7, b"%d" % i, i) is None for i in range(3000))
    assert t.add(3, b"10", -1) == 10
    small = OpenTable(10)
    assert small.add(1, b"x" * 100, 0) is None
    with pytest.raises(MemoryError):
        small.add(2, b"y", 1)
