"""Prefix trie against brute force over explicit prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pandas as pd
import pytest

from roadcast.llm import prefix_trie
from roadcast.llm.prefix_trie import trie

from .helpers import SF, table

COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """(conv_id, turn, role, text) rows -> sorted node rows."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [v[2:] for v in sorted(vs, key=lambda v: v[:2])] for c, vs in own.items()}
    nodes, seqs = defaultdict(list), {}
    for c in own:
        base, h = c - (c % 100 if c >= 0 else -(-c % 100)), zlib.crc32(str(c).encode()) % 6
        seqs[c] = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(seqs[c]) + 1):
            nodes[seqs[c][:d]].append(c)
    kids = defaultdict(int)
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, members in nodes.items():
        cost = (len(members) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += cost
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(p)))).encode()).hexdigest())
                  for p, m in nodes.items())


def got(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*COLS).collect())


def talks(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows],
                                 "conv_id long, turn long, role string, text string, len long, items string, TURN long")


def made(seed, n=150, ids=400, words="ab"):
    """Few different turns, so that many prefixes are shared."""
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "bot"]), rng.choice(words) * rng.randrange(3))
            for c in rng.sample(range(ids), n) for t in range(rng.randrange(12))]


def test_given_table(spark):
    t = pd.read_parquet(f"{SF}/conversations.parquet")
    rows = list(t[["conv_id", "turn", "role", "text"]].itertuples(index=False, name=None))
    assert got(trie(table(spark, "conversations"))) == brute(rows)


@pytest.mark.parametrize("depth,piece,turns", [(256, 4096, 100_000), (3, 7, 20), (1, 2, 5)])
def test_shared_prefixes(spark, monkeypatch, depth, piece, turns):
    """Small limits: splitters end early, pieces and shards are cut, tails run on."""
    for name, x in (("DEPTH", depth), ("PIECE", piece), ("SHARD_TURNS", turns)):
        monkeypatch.setattr(prefix_trie, name, x)
    rows = made(depth)
    base = [(c, t, "user", "a" * (t % 3)) for c in (500, 501, 502, 577) for t in range(30)]      # long copies
    base += [(578, t, "user", "a" * (t % 3) if t < 25 else "z") for t in range(40)]              # that part late
    assert got(trie(talks(spark, rows + base))) == brute(rows + base)


def test_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "DEPTH", 16)
    monkeypatch.setattr(prefix_trie, "PIECE", 50)
    rows = [(700, t, "u", f"t{t}" if t % 5 else None) for t in range(1500)]
    rows += [(c, t, "u", f"t{t}" if t % 5 else None) for c in (701, 702) for t in range(60)] + [(900, 0, "u", "x")]
    assert got(trie(talks(spark, rows))) == brute(rows)


def test_nulls_ties_negative_ids(spark):
    rows = [(None, 0, "u", "lost"), (1, None, None, None), (1, None, None, None), (1, 0, "u", ""), (2, 3, "u", "late"), (2, 1, "u", "early"),
            (2, None, "u", "first"), (0, 5, "", "a"), (0, 6, None, "a"), (-7, 1, "u", "é" * 9), (-107, 1, "u", "b"), (-100, 0, "u", "c"),
            (10 ** 15, 2, "u", "far"), (10 ** 15 + 55, 2, "u", "far"), (3, 1, "same", "same"), (3, 1, "same", "same")]
    rows += [(c, 0, "u", "only") for c in range(1200, 1230)]            # several stay without turns: their base is absent
    rows = [r for r in rows if r[0] != 1200]
    assert got(trie(talks(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert trie(talks(spark, made(1, 2)).limit(0)).count() == 0
    assert trie(talks(spark, [(None, 1, "u", "x")])).count() == 0
