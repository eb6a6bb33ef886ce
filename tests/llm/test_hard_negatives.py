"""Strassen's recursion, heaps and whole results against brute force."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from meteorill.llm import hard_negatives
from meteorill.llm.catalog import QUERIES
from pyspark.sql import functions as F

SCHEMA = "vec_id bigint, embedding array<float>, label int, vector string, anchor string, share string, strip string, place string, rank string"


def brute(rows, is_anchor=lambda i: i % 3 == 0):
    usable = {}
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable[vec_id, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)] = None

    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    def order(pair):
        return (-pair[0], pair[1] is None, pair[1] or 0)

    out = []
    for anchor, label, vector in usable:
        if anchor is None or not is_anchor(anchor):
            continue
        others = [(score(vector, v), i, own) for i, own, v in usable if i != anchor]
        for positive, pid, _ in sorted((o for o in others if o[2] == label), key=order)[:5]:
            fit = [o for o in others if o[2] != label and 80 * positive <= 100 * o[0] <= 100 * positive]
            out += [(anchor, pid, k, i, positive, s) for k, (s, i, _) in enumerate(sorted(fit, key=order)[:5], 1)]
    return sorted(out, key=str)


def make(spark, rows):
    return spark.createDataFrame([(i, v, label, *"xxxxxx") for i, v, label in rows], SCHEMA).repartition(3)


def found(df, **parameters):
    return sorted((tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 3 == 0, **parameters).collect()), key=str)


@settings(max_examples=60, deadline=None)
@given(st.tuples(*[st.integers(0, 40)] * 3), st.integers(1, 9), st.integers(0, 1 << 30))
def test_product(sides, leaf, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(1 << 20), 1 << 20, sides[:2]), rng.integers(-(1 << 20), 1 << 20, sides[1:])
    assert (hard_negatives.strassen(a, b, leaf) == a @ b).all()


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed, monkeypatch):
    """Many ties, several strips, shares and tiles."""
    monkeypatch.setattr(hard_negatives, "GROUP_ANCHORS", 20)
    monkeypatch.setattr(hard_negatives, "GROUP_ROWS", 40)
    rng = random.Random(seed)
    rows = [(i, [round(rng.uniform(-0.3 + seed * 0.2, 1), 1) for _ in range(rng.choice([3, 5]))], rng.choice([0, 0, 0, 1, 2])) for i in range(150)]
    assert found(make(spark, rows)) == brute(rows) != []


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [1.0, 0.5 + i % 2 / 4], i % 3) for i in range(24)]
    odd = [(30, None, 1), (33, [], 0), (36, [1.0, None], 0), (39, [nan, 1.0], 1), (42, [inf, 1.0], 1), (45, [1.0, 0.5], None), (None, [1.0, 0.5], 0), (48, [1.0], 0), (None, [1.0, 0.5], 1)]
    rows = [*good, *odd, good[3], good[4], (6, [9.0, 9.0], 0), (51, [2.0] * 300, 2)]
    assert found(make(spark, rows)) == brute(rows) != []


def test_one_vector_very_often(spark):
    rows = [(i, [0.5, 0.25], i % 2) for i in range(300)]
    assert found(make(spark, rows)) == brute(rows) != []


def test_empty_and_too_large(spark):
    assert found(make(spark, [])) == []
    with pytest.raises(Exception, match="2\\*\\*56"):
        found(make(spark, [(0, [1e30], 0), (1, [1.0], 0)]))


def test_query_gives_whole_windows(spark, sf_dir):
    rows = QUERIES["op12_hard_negative_mining"](spark, sf_dir).collect()
    given_rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    moved = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in given_rows]
    assert sorted((tuple(r) for r in rows), key=str) == brute(moved, lambda i: i % 100 == 0) != []
