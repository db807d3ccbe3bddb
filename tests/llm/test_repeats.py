import hashlib
import random

import numpy as np
import pytest

from roadcast.llm.repeats import RunIndex, anchors, merged, remove_repeats, suffix_order

from .helpers import docs, odd_rows, table


def brute(rows):
    first = {}
    data = [(2**63 - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for p in range(len(b) - 99):
            w = b[p:p + 100]
            first[w] = min(first.get(w, (i, p)), (i, p))
    out = []
    for (own, _), (i, b) in zip(rows, data):
        gone = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - 99):
            if first[b[p:p + 100]] < (i, p):
                gone[p:p + 100] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        rest = bytes(np.frombuffer(b, dtype=np.uint8)[~gone[:-1]])
        out.append((own, len(b), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    return sorted((tuple(r) for r in remove_repeats(docs(spark, rows).repartition(4), **kw).collect()), key=str)


@pytest.mark.parametrize("block", [16_384, 3])
def test_driver_table(spark, block):
    rows = [(r[0], r[1]) for r in table(spark).select("doc_id", "text").collect()]
    assert run(spark, rows, block=block) == brute(rows)


@pytest.mark.parametrize("block", [16_384, 4])
def test_passages_periods_and_copies(spark, block):
    rng = random.Random(9)
    word = [f"{a}{b}" for a in ("ka", "to", "ri", "mo") for b in ("n", "s", "lle")]

    def prose(n):
        return " ".join(rng.choice(word) + str(rng.randrange(1000)) for _ in range(n))
    passage = [prose(k) for k in (14, 18, 25, 40, 90)]
    rows = []
    for i in range(60):
        parts = [prose(rng.randrange(1, 20)) for _ in range(3)]
        for p in rng.sample(passage, rng.randrange(0, 3)):
            cut = rng.randrange(0, 30)
            parts.insert(rng.randrange(len(parts)), p[cut:] if rng.random() < 0.5 else p)
        rows.append((rng.randrange(10_000), " ".join(parts)))
    rows += [(20_000, "ab" * 400), (20_001, "x" * 700), (5, "x" * 350), (20_002, "ba" * 300), (20_003, passage[4]), (20_004, passage[4])]
    rows += [(30_000, "".join(chr(rng.choice([0, 65, 0x20AC])) for _ in range(400)))] * 2 + [(30_001, "\0" * 300)]
    assert run(spark, rows, block=block) == brute(rows)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()] + [(50, "same id " * 40), (50, "other start " + "same id " * 40)]
    assert run(spark, rows) == brute(rows)
    assert remove_repeats(docs(spark, [])).count() == 0


def test_kept_bytes_and_spans(spark):
    rows = [(1, "a" * 30 + "0123456789" * 12), (2, "b" * 30 + "0123456789" * 12 + "c")]
    got = {r["doc_id"]: r for r in remove_repeats(docs(spark, rows), with_text=True).collect()}
    assert bytes(got[2]["kept"]) == b"b" * 30 + b"c" and [tuple(s) for s in got[2]["spans"]] == [(30, 150)]


def test_every_window_has_its_anchor():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 3, 5000).astype(np.uint8)
    pos = anchors(data)[0]
    for p in range(0, 4900, 7):
        assert ((pos >= p) & (pos <= p + 68)).any()
    assert anchors(data[:99]) is None and anchors(data[:100])[0].size == 1


def test_suffix_order_and_index():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(0, 2, rng.integers(12, 40)).astype(np.uint8)) for _ in range(40)]
    size = np.array([len(t) for t in texts])
    m = np.zeros((40, size.max()), dtype=np.int16)
    for k, t in enumerate(texts):
        m[k, :len(t)] = np.frombuffer(t, dtype=np.uint8).astype(np.int16) + 1
    order = [divmod(int(x), m.shape[1]) for x in suffix_order(m)]
    real = [(r, o) for r, o in order if o < size[r]]
    assert real == sorted(real, key=lambda x: (texts[x[0]][x[1]:], x[0]))
    place = np.arange(40) * 1000
    t, o = RunIndex(m, size, place, 10).stream(size, place, 10)
    got = set(zip(t.tolist(), o.tolist()))
    seen, want = {}, set()
    for k, x in enumerate(texts):
        for p in range(len(x) - 9):
            if x[p:p + 10] in seen:
                want.add((k, p))
            seen.setdefault(x[p:p + 10], (k, p))
    assert got == want


def test_merged():
    s, e = merged(np.array([5, 0, 3, 9]), np.array([7, 3, 4, 12]))
    assert s.tolist() == [0, 5, 9] and e.tolist() == [4, 7, 12]
