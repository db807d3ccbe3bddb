import random

from roadcast.llm.line_chunks import digests, line_chunks, line_dedup

from .helpers import docs, odd_rows, table


def brute(rows, least=32):
    """The rule on sets of bytes, documents in order of their id."""
    spans = {}
    for i, t in rows:
        b = (t or "").encode()
        spans[(i, t)] = [(s, e, n, b[s:e].rstrip(b"\n")) for s, e, n in line_chunks(b)]
    first = {}
    for (i, t), cs in spans.items():
        for s, e, n, body in cs:
            if n > 1 and len(body) >= least:
                at = (i is None, i or 0, s)
                first[body] = min(first.get(body, at), at)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        kept = [b[s:e] for s, e, n, body in spans[(i, t)]
                if not (n > 1 and len(body) >= least and first[body] < (i is None, i or 0, s))]
        out.append((i, None if t is None else b"".join(kept).decode()))
    return sorted(out, key=str)


def run(df):
    return sorted(((r["doc_id"], r["text"]) for r in line_dedup(df).collect()), key=str)


def test_driver_table(spark):
    t = table(spark, sf="/root/testdata/sf0.01")
    rows = [(r[0], r[1]) for r in t.select("doc_id", "text").collect()]
    want = brute(rows)
    assert run(t) == want
    by = {r["doc_id"]: r for r in digests(line_dedup(t)).collect()}
    text = dict(rows)
    for i, left in want:
        assert by[i]["n_lines"] == text[i].count("\n") + 1
        assert (by[i]["n_removed"] == 0) == (left == text[i])


def test_shifted_passages_are_cut_alike(spark):
    rng = random.Random(3)
    passage = [f"line {k} of the shared passage, {rng.random()}" for k in range(40)]
    rows = []
    for i in range(30):
        own = [f"own line {i} {k} {rng.random()}" for k in range(rng.randrange(1, 9))]
        rows.append((i, "\n".join(own + passage + own[::-1])))
    got = dict(run(docs(spark, rows)))
    assert got[0] == rows[0][1]
    for i in range(1, 30):
        left = sum(line in got[i] for line in passage)
        assert left <= 10 and all(f"own line {i} " in x for x in rows[i][1].split("\n") if x not in passage)
        assert all(x in got[i] for x in rows[i][1].split("\n") if x.startswith("own"))


def test_chunks_cover_the_text():
    rng = random.Random(5)
    for _ in range(200):
        b = "\n".join(rng.choice(["a", "", "bb", "ccc d"]) for _ in range(rng.randrange(0, 60))).encode()
        cs = line_chunks(b)
        assert b"".join(b[s:e] for s, e, _ in cs) == b


def test_odd_rows_and_clashing_columns(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    rows += [(60, "first line here\nsecond line here, long enough\n" * 3), (61, "first line here\nsecond line here, long enough\n" * 3)]
    d = docs(spark, rows)
    assert run(d) == brute(rows)
    kept = line_dedup(d, keep=("size", "key", "id", "source"))
    assert kept.columns == ["doc_id", "text", "n_lines", "n_removed", "n_chunks", "size", "key", "id", "source"]
    assert {(r["size"], r["key"], r["id"]) for r in kept.collect()} == {(7, "k", "x")}
    assert line_dedup(docs(spark, [])).count() == 0
