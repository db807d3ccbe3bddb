from collections import Counter
from glob import glob

import pyarrow.parquet as pq

import corpus_pipeline as cp
from roadcast.llm.mixing import mix
from roadcast.llm.queries import QUERIES

from .helpers import WORD, docs, odd_rows, table

SF = "/root/testdata/sf0.01"


def spread(order, total, stretch, slack):
    """Any stretch of ``order`` (source, words) holds each source near its share of all words."""
    at, ends, seen = 0, [0], [Counter()]
    for source, n in order:
        at += n
        ends.append(at)
        seen.append(seen[-1] + Counter({source: n}))
    whole, k = sum(total.values()), 0
    for j, end in enumerate(ends):
        while end - ends[k] > stretch:
            k += 1
        if end - ends[k] > stretch / 2:
            for s, n in total.items():
                assert abs(seen[j][s] - seen[k][s] - (end - ends[k]) * n / whole) <= slack, (j, k, s)


def test_places_are_interleaved(spark):
    t = table(spark, sf=SF)
    source = {r["doc_id"]: r["source"] for r in t.collect()}
    got = mix(t).collect()
    pieces, total = [], Counter()
    for r in got:
        assert sum(p["words"] for p in r["places"]) == r["taken"]
        assert sum(p["words"] for p in r["places"] if p["turn"] == 0) == r["first"]
        assert [tuple(p) for p in r["places"]] == sorted(tuple(p) for p in r["places"])
        total[source[r["doc_id"]]] += r["taken"]
        pieces += [(p["at"], p["from"], source[r["doc_id"]], p["words"]) for p in r["places"]]
    pieces.sort()
    slots = {}
    for at, start, s, n in pieces:                  # a slot is one source's, filled without gaps
        if at < 1 << 62:
            assert slots.setdefault(at, (s, 0)) == (s, start)
            slots[at] = (s, start + n)
    block = max(n for _, n in slots.values())
    assert len(slots) > 300
    spread([(s, n) for _, _, s, n in pieces], total, 60 * block, 4 * block)


def test_query_has_the_places(spark):
    got = QUERIES["op8_source_schedule"](spark, SF)
    assert "places" in got.columns and got.where("taken > 0 and size(places) = 0").count() == 0
    assert all(r["places"] == [] for r in mix(docs(spark, odd_rows())).where("size = 0").collect())


def test_pipeline_stage_is_written_in_the_order_of_the_mix(spark, tmp_path):
    t, path = table(spark, sf=SF), str(tmp_path / "mix")
    cp.mixture(spark, t, "").write.parquet(path)
    rows = [x for f in sorted(glob(f"{path}/part-*")) for x in pq.read_table(f, columns=["source", "text"]).to_pylist()]
    order = [(r["source"], len(WORD.findall(r["text"]))) for r in rows]
    total = Counter()
    for s, n in order:
        total[s] += n
    longest = max(n for _, n in order)
    spread(order, total, sum(total.values()) // 4, max(3 * longest, sum(total.values()) // 25))


def test_texts_are_cut_without_python_workers(spark):
    texts = ["a b c", " \t\na\x0b\x0cb\r\rc d ", " x y z w", "\U0001f600 \U0001f601\n\n\U0001f602", "a\x1fb c  "]
    rows = [(t, n) for t in texts for n in range(1, len(WORD.findall(t)) + 1)]
    got = spark.createDataFrame(rows, "text string, n long").withColumn("cut", cp._first_words("text", "n")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["cut"] == r["text"][:[m.end() for m in WORD.finditer(r["text"])][r["n"] - 1]], r
    core = table(spark).select(*cp.CORE)
    plan = cp.mixture(spark, core, SF)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Python" not in plan
