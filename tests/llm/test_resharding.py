import itertools
import zlib

import pytest
from meteorill.llm import resharding as rs
from pyspark.sql import functions as F


def cheapest(supply, capacity, cost):
    """By trying all ways to send single units."""
    units = [i for i, n in enumerate(supply) for _ in range(n)]
    rooms = [j for j, n in enumerate(capacity) for _ in range(n)]
    return min(sum(cost(i, j) for i, j in zip(units, order, strict=True)) for order in set(itertools.permutations(rooms)))


@pytest.mark.parametrize("supply,capacity", [([3, 2], [2, 2, 1]), ([4, 0, 2], [2, 2, 2]), ([1, 1, 1, 1], [0, 4]), ([6], [1, 2, 3]), ([0], [0])])
@pytest.mark.parametrize("cost", [lambda i, j: int(i != j), lambda i, j: (3 * i + 2 * j) % 5])
def test_flow_is_cheapest(supply, capacity, cost):
    flow = rs.min_cost_flow(supply, capacity, cost)
    assert [sum(v for (i, _), v in flow.items() if i == k) for k in range(len(supply))] == supply
    assert [sum(v for (_, j), v in flow.items() if j == k) for k in range(len(capacity))] == capacity
    assert sum(v * cost(i, j) for (i, j), v in flow.items()) == cheapest(supply, capacity, cost)


def test_flow_needs_equal_sums():
    with pytest.raises(ValueError):
        rs.min_cost_flow([1], [2], lambda i, j: 0)


def check(docs, written, shards):
    rows = written.collect()
    text = {}
    assert len(rows) == docs.count()
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
    for group in by_shard.values():
        assert sorted(r["slot"] for r in group) == list(range(len(group)))
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] is None, zlib.crc32((r["text"] or "").encode()))
    assert sorted(map(key, rows)) == sorted(map(key, docs.collect()))
    sizes = [sum(16 + len((r["text"] or "").encode()) for r in by_shard.get(k, [])) for k in range(shards)]
    return sizes, text


def test_shards_are_even_and_moves_few(make_docs):
    docs = make_docs(["w" * (40 + 37 * k % 300) for k in range(600)])
    old = F.when(F.col("doc_id") < 300, 0).otherwise(F.pmod("doc_id", F.lit(4)))
    plan = rs.plan_resharding(docs, old, 5)
    sizes, _ = check(docs, rs.rewrite(docs, old, plan), 5)
    assert max(sizes) - min(sizes) <= 400
    least = sum(v for (i, j), v in plan.flow.items() if i != j)
    assert plan.moved_bytes() <= 1.02 * least + 2000


def test_untouched_shards_are_not_rewritten(make_docs):
    docs = make_docs(["w" * 84] * 400)
    even = F.pmod("doc_id", F.lit(4))
    plan = rs.plan_resharding(docs, even, 4)
    assert plan.affected() == set() and plan.moved_bytes() == 0
    check(docs, rs.rewrite(docs.select("doc_id", "text"), even, plan), 4)


def test_odd_rows(odd_docs, no_docs):
    old = F.pmod(F.xxhash64("text"), F.lit(3))
    written = rs.rewrite(odd_docs, old, rs.plan_resharding(odd_docs, old, 4))
    check(odd_docs, written, 4)
    assert {"lang", "class", "moved"} <= set(written.columns)
    assert rs.rewrite(no_docs, old, rs.plan_resharding(no_docs, old, 4)).count() == 0
