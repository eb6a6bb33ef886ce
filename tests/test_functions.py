import pytest
from pyspark.sql import functions as F

from meteorill.functions import codes, dates, metrics, numbers
from meteorill.schemas import SEASON_BY_MONTH


def test_date_parts(spark, rows):
    df = spark.createDataFrame([(19700101,), (20001231,), (19991001,), (None,)], "Date int")
    got = rows(df.select("Date", dates.year_of(), dates.month_of()))
    assert got == [
        (19700101, 1970, 1), (19991001, 1999, 10), (20001231, 2000, 12), (None, None, None),
    ]


def test_station_prefix_equals_the_pattern(spark, rows):
    ids = ["CH", "CH1", "CH000000001", "XCH1", "GM", "GMx", "", None]
    df = spark.createDataFrame([(i,) for i in ids], "ID string")
    by_prefix = df.filter(codes.is_station_of(["CH"]))
    by_pattern = df.filter(F.col("ID").rlike("^CH(?!$)"))
    assert rows(by_prefix) == rows(by_pattern) == [("CH000000001",), ("CH1",)]


# The months of each season, by country.
SEASONS = {
    "CH": {1: [3, 4], 2: [5, 6, 7], 3: [8, 9, 10], 4: [11, 12, 1, 2]},
    "GM": {1: [3, 4, 5], 2: [6, 7, 8], 3: [9, 10, 11], 4: [12, 1, 2]},
    "GR": {1: [3, 4, 5], 2: [6, 7, 8], 3: [9, 10, 11], 4: [12, 1, 2]},
    "BR": {1: [10, 11, 12], 2: [1, 2, 3], 3: [4, 5, 6], 4: [7, 8, 9]},
    "IS": {1: [3, 4, 5], 2: [6, 7, 8], 3: [9, 10, 11], 4: [12, 1, 2]},
}


def test_all_season_cells(spark):
    cells = [(c, m, s) for c, rule in SEASONS.items() for s, months in rule.items() for m in months]
    assert len(cells) == 60 and set(SEASON_BY_MONTH) == set(SEASONS)
    df = spark.createDataFrame(cells, "FIPS_code string, Month int, expected int")
    assert df.filter(~codes.season().eqNullSafe(F.col("expected"))).count() == 0


@pytest.mark.parametrize("code,month", [("CH", 13), ("CH", 0), ("XX", 1), ("CH", None), (None, 1)])
def test_no_season(spark, code, month):
    df = spark.createDataFrame([(code, month)], "FIPS_code string, Month int")
    assert df.select(codes.season()).first()[0] is None


def test_names(spark):
    df = spark.createDataFrame([("GM", 8, 1), ("XX", 13, 5), (None, None, None)], "FIPS_code string, Month int, Season int")
    got = df.select(codes.country_name(), codes.month_name(), codes.season_name()).collect()
    assert [tuple(r) for r in got] == [("Germany", "August", "spring"), (None,) * 3, (None,) * 3]


def test_ratio_of_nothing_is_null(spark):
    df = spark.createDataFrame([(10, 4), (None, 0)], "s bigint, n bigint")
    assert [r[0] for r in df.select(numbers.ratio("s", "n")).collect()] == [2.5, None]


def test_tenths_and_share(spark):
    df = spark.createDataFrame([(253.0, 1, 3)], "T double, n int, total int")
    row = df.select(numbers.from_tenths("T"), numbers.percent_share("n", F.col("total"))).first()
    assert tuple(row) == (25.3, 33.3)


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 2.0)], "prediction double, label double")
    row = df.agg(metrics.rmse(), metrics.accuracy(), metrics.error_rate()).first()
    assert row[0] == pytest.approx(2**0.5) and row[1] == 0.5 and row[2] == 0.5
