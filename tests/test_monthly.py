import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from meteorill.operators import monthly
from meteorill.operators.stations import enrich, weather_from_daily, weather_from_observations, weather_from_partials

OBS = "StationId string, Date int, Variable string, Value int, seq bigint"
STATIONS = "StationIdA string, LATITUDE double, LONGITUDE double, ELEVATION double"


def observations(spark, data):
    return spark.createDataFrame(data, OBS)


def random_observations(n, seed, hot=0.4):
    """Many repeated values of a day, and one station with a large share of the rows."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        station = "CH1" if r.random() < hot else f"GM{r.randint(1, 6)}"
        date = r.choice([1999, 2000]) * 10000 + r.randint(1, 3) * 100 + r.randint(1, 5)
        value = r.choice([None, *range(-20, 20)])
        out.append((station, date, r.choice(["TMAX", "TMIN", "PRCP"]), value, i))
    return out


def first_values(data):
    """First by seq, as a loop."""
    first = {}
    for station, date, variable, value, seq in sorted(data, key=lambda row: row[4]):
        first.setdefault((station, date, variable), value)
    return first


def brute_force(data, divisor):
    months = defaultdict(list)
    for (station, date, variable), value in first_values(data).items():
        if value is not None:
            months[station, date // 100 % 100, date // 10000, variable].append(value)
    result = {}
    for station, month, year in {key[:3] for key in months}:
        values = [months.get((station, month, year, v)) for v in ("TMAX", "TMIN", "PRCP")]
        if all(values):
            size = len if divisor == "count" else lambda v: len(set(v))
            result[station, month, year] = tuple(sum(v) / size(v) for v in values)
    return result


def test_pivot(spark, rows):
    df = observations(
        spark,
        [
            ("CH1", 20000101, "TMAX", 7, 2),
            ("CH1", 20000101, "TMAX", 9, 1),
            ("CH1", 20000101, "TMIN", 1, 3),
            ("CH1", 20000101, "PRCP", 0, 4),
            ("CH1", 20000102, "PRCP", 4, 5),
            ("CH2", 20000101, "TMAX", None, 6),
        ],
    )
    assert rows(monthly.daily_pivot(df)) == [
        ("CH1", 20000101, 9, 1, 0), ("CH1", 20000102, None, None, 4), ("CH2", 20000101, None, None, None),
    ]


def test_pivot_without_order_takes_the_lowest(spark, rows):
    df = observations(spark, [("CH1", 20000101, "TMAX", 9, 1), ("CH1", 20000101, "TMAX", 7, 2)])
    assert rows(monthly.daily_pivot(df.drop("seq")), "TMAX") == [(7,)]


def test_missing_variable_keeps_its_type(spark):
    df = monthly.monthly_partials(observations(spark, [("CH1", 20000101, "TMAX", 7, 2)]))
    assert df.schema["SumTmin"].dataType.typeName() == "long"
    assert (df.first().SumTmin, df.first().countTmin) == (None, 0)


@pytest.mark.parametrize(
    "divisor,average", [("count", 40 / 3), ("distinct", 20.0), ("approx_distinct", 20.0)]
)
def test_divisors(spark, divisor, average):
    data = []
    for day, value in enumerate([10, 10, 20], 1):
        data += [("CH1", 20000100 + day, v, value, day) for v in ("TMAX", "TMIN", "PRCP")]
    merged = monthly.monthly_partials(observations(spark, data), divisor)
    row = monthly.monthly_averages(merged).first()
    assert row.AvgTmax == row.AvgTmin == row.AvgPrcp == average


def test_unknown_divisor(spark):
    with pytest.raises(ValueError):
        monthly.monthly_partials(observations(spark, []), "median")


@pytest.mark.parametrize("divisor", ["count", "distinct"])
@pytest.mark.parametrize("seed", [1, 2])
def test_averages_against_brute_force(spark, divisor, seed):
    data = random_observations(3000, seed)
    stations = spark.createDataFrame([("CH1", 1.0, 2.0, 3.0)], STATIONS)
    df = weather_from_observations(observations(spark, data), stations, divisor)
    got = {(r.StationId, r.Month, r.Year): (r.AvgTmax, r.AvgTmin, r.AvgPrcp) for r in df.collect()}
    expected = brute_force(data, divisor)
    assert got == expected and expected


def test_batches_merge_to_the_whole(spark, rows):
    """However days are dealt to batches, the merged partials are those of one batch."""
    df = observations(spark, random_observations(3000, 3))
    whole = rows(monthly.monthly_partials(df))
    for n in (1, 2, 7):
        batched = df.withColumn("batch_id", F.col("Date") % n)
        assert rows(monthly.merge_partials(monthly.monthly_partials(batched))) == whole


def test_first_values_by_batch_give_the_first_of_all(spark, rows):
    """Batches that cut through days do not change the result of the daily table."""
    df = observations(spark, random_observations(3000, 4))
    stations = spark.createDataFrame([("CH1", 1.0, 2.0, 3.0)], STATIONS)
    whole = rows(weather_from_observations(df, stations))
    daily = monthly.daily_values(df.withColumn("batch_id", F.col("seq") % 5))
    assert rows(weather_from_daily(daily, stations)) == whole


def test_enrich_keeps_unknown_stations(spark, rows):
    df = spark.createDataFrame([("CH1", 1), ("GM2", 2), (None, 3)], "StationId string, n int")
    stations = spark.createDataFrame([("CH1", 1.0, 2.0, 3.0)], STATIONS)
    assert rows(enrich(df, stations)) == [
        ("CH1", 1, "CH", 1.0, 2.0, 3.0),
        ("GM2", 2, "GM", None, None, None),
        (None, 3, None, None, None, None),
    ]


PARTIAL_ROWS = (
    "StationId string, Month int, Year int, SumTmax long, SumTmin long, SumPrcp long, "
    "countTmax long, countTmin long, countPrcp long, FIPS_code string, LATITUDE double, "
    "LONGITUDE double, ELEVATION double, batch_id long"
)


def test_weather_from_partials_takes_the_stations_of_today(spark, rows):
    """Coordinates that came or changed between batches do not split a month."""
    here, nowhere = ("CH", 1.0, 2.0, 3.0), ("GM", None, None, None)
    data = [
        ("CH1", 1, 2000, 10, 4, 1, 2, 2, 1, "CH", None, None, None, 0),
        ("CH1", 1, 2000, 20, None, 3, 1, 0, 3, "CH", 9.0, 9.0, 9.0, 1),
        ("CH1", 2, 2000, None, None, 3, 0, 0, 3, *here, 1),
        ("GM2", 1, 2000, 1, 1, 1, 1, 1, 1, *nowhere, 0),
        ("GM2", 1, 2000, 3, 1, 1, 1, 1, 1, *nowhere, 1),
    ]
    stations = spark.createDataFrame([("CH1", 1.0, 2.0, 3.0)], STATIONS)
    got = rows(weather_from_partials(spark.createDataFrame(data, PARTIAL_ROWS), stations))
    assert got == [
        ("CH1", 1, 2000, 10.0, 2.0, 1.0, *here),
        ("GM2", 1, 2000, 2.0, 1.0, 1.0, *nowhere),
    ]


def test_repeated_station_lines_count_once(spark, rows):
    lines = [("CH1", None, 2.0, 3.0), ("CH1", 1.0, 2.0, 3.0), ("CH1", 1.0, 2.0, 3.0), ("CH1", 0.5, 9.0, 9.0)]
    stations = spark.createDataFrame(lines, STATIONS)
    df = spark.createDataFrame([("CH1", 1)], "StationId string, n int")
    assert rows(enrich(df, stations)) == [("CH1", 1, "CH", 1.0, 2.0, 3.0)]
    data = observations(spark, random_observations(500, 6))
    assert weather_from_observations(data, stations).count() == weather_from_observations(data, stations.limit(0)).count()


@pytest.mark.parametrize("divisor", ["distinct", "approx_distinct"])
def test_divisors_that_do_not_merge_are_refused_by_batch(spark, divisor):
    batched = observations(spark, []).withColumn("batch_id", F.lit(0))
    with pytest.raises(ValueError, match="merged"):
        monthly.monthly_partials(batched, divisor)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_aggregates_before_each_shuffle(spark):
    text = plan(monthly.monthly_partials(observations(spark, random_observations(10, 1))))
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("partial_min_by") == 3 and text.count("partial_sum") == 3
    assert "SortAggregate" not in text and "Expand" not in text


def test_distinct_divisor_does_not_multiply_rows(spark):
    text = plan(monthly.monthly_partials(observations(spark, random_observations(10, 1)), "distinct"))
    assert "Expand" not in text and "SortAggregate" not in text


def test_stations_are_broadcast_only_below_the_limit(spark, rows):
    facts = monthly.monthly_partials(observations(spark, random_observations(500, 5)))
    stations = spark.createDataFrame([("CH1", 1.0, 2.0, 3.0)], STATIONS)
    small = spark.range(9).select(
        F.concat(F.lit("GM"), F.col("id").cast("string")).alias("StationIdA"), *[F.lit(1.0).alias(c) for c in ("LATITUDE", "LONGITUDE", "ELEVATION")],
    )
    assert "BroadcastHashJoin" in plan(enrich(facts, small))
    expected = rows(enrich(facts, stations))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(enrich(facts, stations))
        assert rows(enrich(facts, stations)) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_estimates_are_of_one_month_at_a_time(spark):
    """No task holds or shuffles a buffer for each of its months; the estimates are those of the aggregation."""
    rows = [("CH1", 20000100 + d, v, (d * d + 7 * k) % 11 if d % 4 else None, 100 * d + k) for d in range(1, 29) for k, v in enumerate(("TMAX", "TMIN", "PRCP"))]
    obs = spark.createDataFrame([*rows, ("CH1", 20000201, "SNWD", 3, 1), ("GM2", 20000101, "TMAX", 5, 1)], "StationId string, Date int, Variable string, Value int, seq bigint")
    found = monthly.monthly_partials(obs, "approx_distinct")
    assert "partial_approx_count_distinct" not in found._jdf.queryExecution().executedPlan().toString()
    days = monthly.with_month(monthly.daily_pivot(obs)).groupBy("StationId", "Month", "Year")
    sums = [F.sum(v).alias(s) for v, s in zip(monthly.SUFFIX, monthly.SUMS, strict=True)]
    counts = [F.approx_count_distinct(v).alias(c) for v, c in zip(monthly.SUFFIX, monthly.COUNTS, strict=True)]
    assert sorted(map(str, found.collect())) == sorted(map(str, days.agg(*sums, *counts).collect()))
