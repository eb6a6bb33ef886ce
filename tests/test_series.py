import math
import random

import pytest

from meteorill.operators import series
from meteorill.schemas import WEATHER


@pytest.fixture(scope="module")
def table(spark):
    r = random.Random(5)
    data = []
    for code in ("CH", "GM", "GR", "BR"):
        for station in range(5):
            for year in (1975, 1985, 1995, 2000):
                for month in (1, 2, 8):
                    avg = [float(r.randint(0, 300)) for _ in range(3)]
                    data.append((f"{code}{station}", month, year, *avg, code, 1.0 * station, 2.0, 3.0))
    data.append(data[0])
    return data, spark.createDataFrame(data, WEATHER)


def test_top_stations(table, rows):
    assert rows(series.top_stations(table[1], ["CH", "GM"], 2)) == [
        ("CH", "CH0", 1), ("CH", "CH1", 2), ("GM", "GM0", 1), ("GM", "GM1", 2),
    ]


def test_rank_limit_is_applied_before_the_shuffle(table):
    plan = series.top_stations(table[1], ["CH"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_temporal(table, rows):
    data, df = table
    expected = {(d[0], d[2], d[5], d[3], d[1]) for d in data if d[0] in ("GM0", "GM1", "GM2") and d[1] in (1, 8)}
    assert rows(series.temporal(df)) == sorted(expected)
    got = [tuple(r) for r in series.temporal_series(df).collect()]
    long = [(s, m, y, "PRCP", p) for s, y, p, t, m in expected]
    long += [(s, m, y, "T", t / 10) for s, y, p, t, m in expected]
    assert got == sorted(long, key=lambda v: (v[0], v[1], v[3], v[2]))


def test_spatial(table, rows):
    data, df = table
    expected = sorted(
        {(d[0], d[8], d[7], d[5]) for d in data if d[6] == "GM" and d[2] == 2000 and d[1] == 2}
    )
    assert rows(series.spatial(df, "GM", 2)) == expected
    slices = rows(series.spatial_slices(df), "FIPS_code", "country", "Month", "month_name", "StationId", "AvgPrcp")
    names = {"CH": "China", "BR": "Brazil", "GM": "Germany"}
    months = {2: "February", 8: "August"}
    assert slices == sorted(
        {(d[6], names[d[6]], d[1], months[d[1]], d[0], d[5])
         for d in data if d[6] in names and d[1] in months and d[2] == 2000}
    )


def test_pairs_equal_slices_for_all_pairs(table, rows):
    df = table[1]
    columns = ["FIPS_code", "Month", "StationId", "LONGITUDE", "LATITUDE", "AvgPrcp"]
    pairs = [(c, m) for c in ("CH", "BR", "GM") for m in (2, 8)]
    assert rows(series.spatial_pairs(df, pairs + pairs[:1])) == rows(series.spatial_slices(df), *columns)
    assert series.spatial_pairs(df, []).count() == 0
    one = rows(series.spatial_pairs(df, [("GM", 2)]), "StationId", "LONGITUDE", "LATITUDE", "AvgPrcp")
    assert one == rows(series.spatial(df, "GM", 2))


def test_spatiotemporal(table, rows):
    data, df = table
    expected = {(d[0], d[1], d[5], d[2]) for d in data
                if d[0] in ("GM0", "GR0", "CH0") and d[2] in (1975, 1985, 1995)}
    assert rows(series.spatiotemporal(df)) == sorted(expected)
    got = [tuple(r) for r in series.spatiotemporal_series(df).collect()]
    assert got == sorted((y, s, m, p) for s, m, p, y in expected)


def test_correlation(spark, table):
    data, df = table
    for row in series.temp_prcp_corr(df.distinct()).collect():
        pairs = [(d[3], d[5]) for d in set(data) if d[0] == row.StationId and d[1] == row.Month]
        n = len(pairs)
        assert row.n_years == n
        mx, my = sum(p[0] for p in pairs) / n, sum(p[1] for p in pairs) / n
        cov = sum((x - mx) * (y - my) for x, y in pairs)
        vx, vy = sum((x - mx) ** 2 for x, _ in pairs), sum((y - my) ** 2 for _, y in pairs)
        assert row["corr"] == pytest.approx(cov / math.sqrt(vx * vy))


def test_correlation_of_a_constant_is_null(spark):
    data = [("CH1", 1, y, 5.0, 0.0, float(y), "CH", 1.0, 2.0, 3.0) for y in (1999, 2000)]
    row = series.temp_prcp_corr(spark.createDataFrame(data, WEATHER)).first()
    assert row.n_years == 2 and row["corr"] is None


def test_distinct_values(table, rows):
    assert rows(series.distinct_values(table[1], "Month")) == [(1,), (2,), (8,)]


def test_pairs_prune_the_scan(weather):
    plan = series.spatial_pairs(weather, [("GM", 2), ("CH", 8)])._jdf.queryExecution().executedPlan().toString()
    assert "FIPS_code" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert " IN (CH,GM)" in plan and "In(Month, [2,8])" in plan
