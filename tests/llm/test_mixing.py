from collections import defaultdict

import pytest

from roadcast.llm.mixing import _slots, mix, schedule, target_sizes

from .helpers import WORD, docs, odd_rows, table


def brute_targets(sizes, weights):
    total, fixed = 1.5 * sum(sizes), {}
    while True:
        rest = [i for i in range(len(sizes)) if i not in fixed]
        left = total - sum(fixed.values())
        want = {i: left * weights[i] / sum(weights[j] for j in rest) for i in rest}
        over = [i for i in rest if want[i] > 2 * sizes[i] * (1 + 1e-12)]
        if not over:
            return [fixed.get(i, want.get(i)) for i in range(len(sizes))]
        fixed.update({i: 2.0 * sizes[i] for i in over})


def check(df, got):
    src = defaultdict(lambda: [0, 0])
    for r in df.collect():
        src[r["source"]][0] += len(WORD.findall(r["text"] or ""))
    order = sorted(src, key=lambda s: (s is None, s or ""))
    sizes = [src[s][0] for s in order]
    targets = dict(zip(order, brute_targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(order))])))
    by_id = defaultdict(list)
    for r in df.collect():
        by_id[r["doc_id"]].append((len(WORD.findall(r["text"] or "")), r["source"]))
    taken = defaultdict(int)
    assert len(got) == df.count()
    for r in got:
        size, source = next((x for x in by_id[r["doc_id"]] if x[0] == r["size"]
                             and abs(targets[x[1]] - r["target"]) < 1e-6 * max(1, r["target"])))
        assert r["source_size"] == src[source][0]
        assert 0 <= r["taken"] <= 2 * size
        assert r["taken"] == r["first"] + r["second"]
        taken[source] += r["taken"]
    for s in order:
        assert abs(taken[s] - targets[s]) <= 1, (s, taken[s], targets[s])


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_driver_table(spark, sf):
    t = table(spark, sf=f"/root/testdata/sf{sf}")
    got = mix(t).collect()
    check(t, got)
    assert sorted(map(str, got)) == sorted(map(str, mix(t.repartition(5)).collect()))


def test_odd_rows_and_empty_table(spark):
    d = docs(spark, odd_rows())
    check(d, mix(d).collect())
    assert mix(docs(spark, [])).count() == 0
    blank = docs(spark, [(1, None, None, "a"), (2, " ", None, "b")])
    assert [r["taken"] for r in mix(blank).collect()] == [0, 0]


def test_targets_stop_at_twice_the_source():
    assert target_sizes([100, 100, 1000], [3, 1, 2]) == brute_targets([100, 100, 1000], [3, 1, 2])
    assert target_sizes([10, 10], [1, 1]) == [15.0, 15.0]
    assert target_sizes([0, 10], [3, 1]) == [0.0, 15.0]


def test_schedule_is_spread(spark):
    plan = [(0, 10_000, 15_000), (1, 20_000, 10_000), (2, 700, 1_400)]
    slots = sorted(schedule(spark, plan, 10).collect(), key=lambda r: r["at"])
    need = {no: _slots(n, w, 10) for no, n, w in plan}
    seen = defaultdict(list)
    for r in slots:
        seen[r["src_no"]].append(r["nth"])
    assert {no: len(v) for no, v in seen.items()} == need
    assert all(v == list(range(len(v))) for v in seen.values())      # a source's slots take its blocks in order
    total = sum(need.values())
    for start in range(0, total - 400, 173):                         # any stretch holds each source near its weight
        part = [r["src_no"] for r in slots[start:start + 400]]
        assert all(abs(part.count(no) - 400 * n / total) <= 6 for no, n in need.items())
