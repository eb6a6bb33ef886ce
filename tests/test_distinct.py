"""Divisors by distinct values: what merges over batches, against one batch and against sets."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from meteorill.operators import distinct, monthly
from meteorill.operators.stations import enrich, enrich_as_of, weather_from_bits
from test_monthly import STATIONS, brute_force, first_values, observations, random_observations

KINDS = {
    "bits": (distinct.bit_partials, distinct.merge_bits, distinct.counted_bits),
    "sketches": (distinct.sketch_partials, distinct.merge_sketches, distinct.counted_sketches),
}
COLUMNS = ["StationId", "Month", "Year", *monthly.SUMS, *monthly.COUNTS]


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("batches", [1, 4, 9])
def test_merged_batches_equal_one(spark, rows, kind, batches):
    """However whole days are dealt to batches, and in whatever steps these merge."""
    make, merge, counted = KINDS[kind]
    df = observations(spark, random_observations(3000, 3))
    whole = rows(monthly.monthly_partials(df, "distinct"), *COLUMNS)
    partials = make(df.withColumn("batch_id", F.col("Date") % batches))
    # The bits of a month without values of any kind are no row.
    known = [r for r in whole if any(r[6:])] if kind == "bits" else whole
    assert rows(counted(merge(partials)), *COLUMNS) == known
    early, late = partials.filter("batch_id < 2").drop("batch_id"), partials.filter("batch_id >= 2").drop("batch_id")
    assert rows(counted(merge(merge(early).unionByName(late))), *COLUMNS) == known


def test_sketches_of_batches_are_those_of_the_whole(spark):
    """The union of four batches' sketches and the sketch of all hold the same values: put together they hold no more."""
    df = observations(spark, random_observations(3000, 5))
    whole = distinct.sketch_partials(df)
    merged = distinct.merge_sketches(distinct.sketch_partials(df.withColumn("batch_id", F.col("Date") % 4)))
    names = {c: f"other_{c}" for c in distinct.SKETCHES}
    both = whole.join(merged.withColumnsRenamed(names).drop(*monthly.SUMS), distinct.MONTH)
    assert both.count() == whole.count()
    for c, other in names.items():
        sizes = [F.hll_sketch_estimate(x) for x in (F.col(c), F.col(other), F.hll_union(c, other))]
        assert both.filter((sizes[0] != sizes[1]) | (sizes[0] != sizes[2])).count() == 0


def test_error_of_sketches_with_many_values(spark):
    """Far beyond a month's values the estimate is within four standard errors."""
    values = spark.range(40_000).select(F.lit("CH1").alias("StationId"), F.lit(20000101).alias("Date"), F.col("id").alias("v"))
    estimate = values.groupBy().agg(F.hll_sketch_estimate(F.hll_sketch_agg("v"))).first()[0]
    assert abs(estimate - 40_000) < 4 * 0.016 * 40_000


def test_bits_against_sets(spark):
    """Negative values, values at the ends of words, and a batch that comes again and late."""
    r = random.Random(2)
    data = [("CH1", 20000100 + day, "TMAX", r.choice([-65, -64, -63, -1, 0, 63, 64, 127, 128, 2**31 - 1, -(2**31)]), day) for day in range(1, 29)]
    partials = distinct.bit_partials(observations(spark, data).withColumn("batch_id", F.col("Date") % 3))
    again = partials.unionByName(partials.filter("batch_id = 1").withColumn("Total", F.lit(0).cast("bigint")))
    row = distinct.counted_bits(distinct.merge_bits(again)).first()
    assert (row.countTmax, row.SumTmax) == (len({d[3] for d in data}), sum(d[3] for d in data))
    assert (row.countTmin, row.SumTmin) == (0, None)


def test_a_hot_month_is_reduced_before_the_shuffle(spark):
    plan = distinct.merge_bits(distinct.bit_partials(observations(spark, random_observations(10, 1)).withColumn("batch_id", F.lit(0))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("partial_bit_or") == 2 and "SortAggregate" not in text and "Expand" not in text


def test_weather_from_merged_bits(spark):
    data = random_observations(3000, 8)
    stations = spark.createDataFrame([("CH1", 1.0, 2.0, 3.0)], STATIONS)
    partials = distinct.bit_partials(observations(spark, data).withColumn("batch_id", F.col("Date") % 4))
    got = {(r.StationId, r.Month, r.Year): (r.AvgTmax, r.AvgTmin, r.AvgPrcp) for r in weather_from_bits(partials, stations).collect()}
    assert got == brute_force(data, "distinct") != {}
    assert first_values(data)


def test_stations_as_of_the_month(spark, rows):
    lines = [
        ("CH1", 1.0, 1.0, 1.0, None), ("CH1", 2.0, 2.0, 2.0, 20000201), ("CH1", 0.5, 9.0, 9.0, 20000201), ("CH1", 3.0, 3.0, 3.0, 20000415),
        ("GM2", 5.0, 5.0, 5.0, 20000301),
    ]
    history = spark.createDataFrame(lines, STATIONS + ", ValidFrom int")
    months = spark.createDataFrame([(s, m, y) for s in ("CH1", "GM2", "GR3") for y, m in ((1999, 12), (2000, 1), (2000, 2), (2000, 3), (2000, 4))], "StationId string, Month int, Year int")
    got = defaultdict(dict)
    for r in enrich_as_of(months, history).collect():
        assert r.Month not in got[r.StationId]
        got[r.StationId][r.Month] = r.LATITUDE
    assert got["CH1"] == {12: 1.0, 1: 1.0, 2: 2.0, 3: 2.0, 4: 3.0}
    assert got["GM2"] == {12: None, 1: None, 2: None, 3: 5.0, 4: 5.0}
    assert set(got["GR3"].values()) == {None}
    assert rows(enrich(months, history)) == rows(enrich_as_of(months, history))
