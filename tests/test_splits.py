"""Best splits against brute force, and against the root of the library's trees."""

import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from meteorill.operators import classification, splits
from meteorill.schemas import SEASON_NAMES

SCHEMA = "FIPS_code string, kind int, a double, b double"


def gini(labels):
    return len(labels) - sum(labels.count(c) ** 2 for c in set(labels)) / len(labels)


def brute(rows):
    out = []
    for code in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == code and None not in r]
        found = []
        for place, name in enumerate(("a", "b"), 1):
            values = sorted({r[1 + place] for r in own})
            for low, high in zip(values, values[1:], strict=False):
                left, right = ([r[1] for r in own if (r[1 + place] <= low) == side] for side in (True, False))
                gain = (gini([r[1] for r in own]) - gini(left) - gini(right)) / len(own)
                found.append((-round(gain, 12), place, (low + high) / 2, name, len(left), len(right)))
        if found:
            less, _, threshold, name, n_left, n_right = min(found)
            out.append((code, name, threshold, n_left, n_right, -less))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("ranges", [1, 2, 32])
def test_against_brute_force(spark, seed, ranges):
    r = random.Random(seed)
    codes = ["CH"] * 6 + ["GM", "GR"]
    rows = [(r.choice(codes), r.choice([1, 1, 2, 3]), float(r.randint(0, 12)), r.choice([None, 1.0, 2.5, r.random()])) for _ in range(120)]
    rows += [("IS", 1, 5.0, 5.0)] * 4
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(tuple(x) for x in splits.best_splits(df, "kind", (1, 2, 3), ("a", "b"), ranges=ranges).collect())
    expected = brute(rows)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert [g[5] for g in got] == pytest.approx([e[5] for e in expected], abs=1e-11)


def test_empty(spark):
    assert splits.best_splits(spark.createDataFrame([], SCHEMA), "kind", (1, 2), ("a", "b")).count() == 0


def test_values_of_a_feature_are_spread(spark):
    """A country with nearly all rows: its values are in many ranges, of about equal size."""
    rows = spark.range(20_000).select(F.lit("CH").alias("FIPS_code"), (F.col("id") % 3 + 1).cast("int").alias("kind"), F.col("id").cast("double").alias("a"), F.rand(3).alias("b"))
    counts = splits.class_counts(rows, "kind", (1, 2, 3), ("a", "b"))
    sums = splits.running_sums(counts, (1, 2, 3), ranges=8)
    last = sums.where("next is null").collect()
    assert len(last) == 2 and all(r["l_n_1"] == r["t_n_1"] == 6667 for r in last)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "range" in plan[plan.index("Window") :]


def root_of(model):
    """Feature and threshold of a tree's first split."""
    node = model._call_java("rootNode")
    return node.split().featureIndex(), node.split().threshold()


@pytest.mark.parametrize("code", ["GM", "CH"])
def test_root_of_an_unsampled_tree(weather, code):
    """The library's tree, given a bin for every value, starts with the same rows on either side."""
    rows = classification.labelled_rows(weather, "Season", [code]).filter("split = 'train' and LATITUDE is not null")
    best = splits.best_splits(rows, "Season", SEASON_NAMES).first()
    vectors = VectorAssembler(inputCols=list(splits.FEATURES), outputCol="features").transform(rows).withColumn("y", F.col("Season") - 1)
    bins = rows.count() + 2
    forest = RandomForestClassifier(labelCol="y", numTrees=1, maxDepth=1, maxBins=bins, bootstrap=False, featureSubsetStrategy="all", seed=1).fit(vectors)
    tree = DecisionTreeClassifier(labelCol="y", maxDepth=1, maxBins=bins, seed=1).fit(vectors)
    for found in (forest.trees[0], tree):
        feature, threshold = root_of(found)
        left = rows.filter(F.col(splits.FEATURES[feature]) <= threshold).count()
        gain = 1.0 * best.gain
        assert (splits.FEATURES[feature], left) == (best.feature, best.n_left), gain
