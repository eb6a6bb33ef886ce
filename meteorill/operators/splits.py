"""The best split of every country's rows on every feature, found exactly and for all countries in one job.

A forest's library samples thresholds. Here every value of a feature is tried: rows are counted by (country, feature,
value) and class, and running sums over the values, in order, give the classes on both sides of each threshold.

The running sums do not need all values of a feature in one task. Values are dealt out by ranges; each
range sums up itself, the ranges' totals, a few for each country and feature, are summed up in their order, and a row's
sums are those of its range plus those of the ranges before. A country with a third of all rows, or a feature with as many
values as rows, is spread over as many tasks as there are ranges.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meteorill.operators.features import FOREST_SCALARS
from meteorill.schemas import COORDINATES

FEATURES = (*FOREST_SCALARS, *COORDINATES)
GROUP = ["FIPS_code", "feature"]
#: Parts that the values of a country and feature are summed up in.
RANGES = 32


def class_counts(rows: DataFrame, label: str, classes: Iterable[int], features: Iterable[str] = FEATURES) -> DataFrame:
    """(FIPS_code, feature, value, n_<class>...): rows of each class by value; rows that lack a feature take no part."""
    features = list(features)
    complete = F.lit(True)
    for column in (*features, label):
        complete = complete & F.col(column).isNotNull()
    long = rows.filter(complete).select("FIPS_code", F.col(label).alias("class"), *[F.col(c).cast("double").alias(c) for c in features])
    long = long.unpivot(["FIPS_code", "class"], features, "feature", "value")
    counts = [F.count(F.when(F.col("class") == c, 1)).alias(f"n_{c}") for c in classes]
    return long.groupBy(*GROUP, "value").agg(*counts)


def running_sums(counts: DataFrame, classes: Iterable[int], ranges: int = RANGES) -> DataFrame:
    """`counts` with l_<class> (up to and with the value) and t_<class> (all values), and the value that follows."""
    names = [f"n_{c}" for c in classes]
    # Where the ranges are cut decides nothing but the tasks' sizes. The cuts are fixed numbers from here on, a few for
    # each country and feature, so that a lost task finds the same ranges.
    cuts = counts.groupBy(*GROUP).agg(F.percentile_approx("value", [k / ranges for k in range(1, ranges)] or [0.5], 1000).alias("cuts"))
    known = counts.sparkSession.createDataFrame(cuts.collect(), cuts.schema)
    ranged = counts.join(known, GROUP).withColumn("range", F.size(F.filter("cuts", lambda c: c < F.col("value")))).drop("cuts")
    within = Window.partitionBy(*GROUP, "range").orderBy("value")
    totals = ranged.groupBy(*GROUP, "range").agg(*[F.sum(n).alias(f"r_{n}") for n in names], F.min("value").alias("least"))
    before = Window.partitionBy(*GROUP).orderBy("range")
    whole = Window.partitionBy(*GROUP)
    offsets = totals.select(
        *GROUP, "range",
        *[(F.sum(f"r_{n}").over(before) - F.col(f"r_{n}")).alias(f"o_{n}") for n in names],
        *[F.sum(f"r_{n}").over(whole).alias(f"t_{n}") for n in names],
        F.lead("least").over(before).alias("after"),
    )
    summed = ranged.withColumns({f"w_{n}": F.sum(n).over(within) for n in names} | {"next": F.lead("value").over(within)})
    left = [(F.col(f"w_{n}") + F.col(f"o_{n}")).alias(f"l_{n}") for n in names]
    following = F.coalesce("next", "after").alias("next")
    return summed.join(offsets, [*GROUP, "range"]).select(*GROUP, "value", following, *left, *[f"t_{n}" for n in names])


def _impurity(counts: list[Column], total: Column) -> Column:
    """Gini impurity times the number of rows."""
    squares = sum((c.cast("double") * c for c in counts[1:]), counts[0].cast("double") * counts[0])
    return total - squares / total


def best_splits(rows: DataFrame, label: str, classes: Iterable[int], features: Iterable[str] = FEATURES, ranges: int = RANGES) -> DataFrame:
    """(FIPS_code, feature, threshold, n_left, n_right, gain): of each country the split with the largest gain of Gini
    impurity; the threshold is halfway to the next value. Ties go to the feature first in the list, then to the lower threshold.

    Countries without a split (one value of every feature) have no row; a pure country has one without gain.
    """
    classes, features = list(classes), list(features)
    sums = running_sums(class_counts(rows, label, classes, features), classes, ranges)
    left, all_of = [F.col(f"l_n_{c}") for c in classes], [F.col(f"t_n_{c}") for c in classes]
    right = [t - x for t, x in zip(all_of, left, strict=True)]
    n_left, n = sum(left[1:], left[0]), sum(all_of[1:], all_of[0])
    n_right = n - n_left
    gain = (_impurity(all_of, n) - _impurity(left, n_left) - _impurity(right, n_right)) / n
    place = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature"))
    found = sums.where("next is not null").select(
        "FIPS_code", "feature", ((F.col("value") + F.col("next")) / 2).alias("threshold"), n_left.alias("n_left"), n_right.alias("n_right"), F.round(gain, 12).alias("gain"), place.alias("place")
    )
    best = F.min(F.struct((-F.col("gain")).alias("less"), "place", "threshold", "feature", "n_left", "n_right")).alias("best")
    picked = found.groupBy("FIPS_code").agg(best)
    return picked.select("FIPS_code", *[f"best.{c}" for c in ("feature", "threshold", "n_left", "n_right")], (-F.col("best.less")).alias("gain"))
