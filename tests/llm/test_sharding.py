import zlib
from collections import defaultdict

from roadcast.llm.sharding import shard_by_bytes

from .helpers import docs, odd_rows, table


def check(df, shards=16, near=None):
    got = shard_by_bytes(df, shards).collect()
    want = sorted(((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()))
                   for r in df.collect()), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=str) == want
    slots, size = defaultdict(list), defaultdict(int)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    if near is not None:
        mean = sum(size.values()) / shards
        assert len(size) == shards and max(size.values()) <= mean + near and min(size.values()) >= mean - near
    return got


def test_driver_table(spark):
    t = table(spark, sf="/root/testdata/sf0.01")
    largest = max(len((r[0] or "").encode()) for r in t.select("text").collect())
    got = check(t, near=2 * largest)
    again = {tuple(r) for r in shard_by_bytes(t.repartition(7)).collect()}
    assert {tuple(r) for r in got} == again


def test_a_third_of_all_rows_equal(spark):
    rows = [(i, "same text for many rows" if i % 3 == 0 else f"text number {i} of its own") for i in range(6000)]
    got = check(docs(spark, rows), near=600)
    shard = {r["doc_id"]: r["shard"] for r in got}
    assert len({s for i, s in shard.items() if i % 3 == 0}) >= 5       # the overfull group is subdivided


def test_equal_texts_stay_together(spark):
    rows = [(i, f"text {i % 1500} " * 5) for i in range(6000)]
    shard = defaultdict(set)
    for r in check(docs(spark, rows), near=3000):
        shard[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in shard.values())


def test_odd_rows_and_empty_table(spark):
    check(docs(spark, odd_rows()))
    assert shard_by_bytes(docs(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = shard_by_bytes(table(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
