import random

import numpy as np
import pytest

from roadcast.llm import minhash
from roadcast.llm.components import components
from roadcast.llm.minhash import (band_keys, chance_at_least, least_matches, near_duplicates, shingle_hashes, shingles,
                                  signature)

from .helpers import docs, odd_rows, table


def brute(rows, width, percent=80):
    sets = [shingles((t or "").encode(), width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if both and 100 * both >= percent * len(sets[i] | sets[j]):
                    parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted(((d, len(sets[i]), low.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows, **kw):
    got = near_duplicates(docs(spark, rows), **kw).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str)


@pytest.mark.parametrize("width", [4, 5])
def test_driver_table(spark, width):
    rows = [(r[0], r[1]) for r in table(spark, sf="/root/testdata/sf0.01").select("doc_id", "text").collect()]
    assert run(spark, rows, width=width) == brute(rows, width)


def test_chains_stars_and_copies(spark):
    rng = random.Random(4)
    word = [f"w{i}" for i in range(500)]
    rows, base = [], [rng.choice(word) for _ in range(120)]
    for i in range(60):                             # a drifting chain: neighbours are near, ends are not
        rows.append((i, " ".join(base)))
        base[rng.randrange(120)] = rng.choice(word)
    star = [rng.choice(word) for _ in range(100)]
    for i in range(80):                             # leaves near the hub, not near each other
        leaf = list(star)
        for k in rng.sample(range(0, 100, 25), 2):
            leaf[k] = f"leaf{i}x{k}"
        rows.append((100 + i, " ".join(leaf)))
    rows += [(300, " ".join(star))] + [(400 + i, "exact copy of a text here now") for i in range(50)]
    rng.shuffle(rows)
    assert run(spark, rows, width=4) == brute(rows, 4)


def test_blocks_alone_find_all_links(spark, monkeypatch):
    """Without leaders every link comes from the block-wise comparison, over several blocks a bucket."""
    monkeypatch.setattr(minhash, "LEADER_ROUNDS", 0)
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = random.Random(9)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(i % 4):
            w[rng.randrange(60)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    assert run(spark, rows, width=4) == brute(rows, 4)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert run(spark, rows, width=4) == brute(rows, 4)
    assert near_duplicates(docs(spark, [])).count() == 0


def test_hashes_agree_with_sets():
    for text in [b"", b" \n", b"A b", b"a b c d e a b c d e", "Ünï çode Wörd x\ty".encode() * 50]:
        h, digest = shingle_hashes(text, 4)
        assert h.size == len(shingles(text, 4))
        assert (digest == b"") == (h.size == 0)
    assert shingle_hashes(b"A  b c\nd e", 4)[1] == shingle_hashes(b" a b C d e ", 4)[1] != shingle_hashes(b"ab c d e", 4)[1]


def test_signatures_estimate_similarity():
    a = np.unique(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    b = np.concatenate([a[:900], np.arange(100, dtype=np.uint64) * np.uint64(7919)])
    same = (signature(a) == signature(b)).mean()
    assert abs(same - 900 / 1100) < 0.12
    assert (band_keys(signature(a)) == band_keys(signature(b))).any()


def test_posterior():
    from math import isclose
    grid = np.linspace(0, 1, 200001)
    for m, n in [(20, 30), (30, 30), (5, 30), (100, 150)]:
        like = grid**m * (1 - grid)**(n - m)
        assert isclose(chance_at_least(0.8, m, n), like[grid >= 0.8].sum() / like.sum(), rel_tol=1e-2, abs_tol=1e-12)
    need = least_matches(80)
    assert list(need) == sorted(need) and need[0] < 24


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(70)]
    got = {r["id"]: r["label"] for r in components(spark.createDataFrame(links, "a int, b int")).collect()}
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for v, label in got.items():
        seen, todo = {v}, [v]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert label == min(seen)
