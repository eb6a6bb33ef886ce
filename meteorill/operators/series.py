"""Temporal, spatial and spatio-temporal slices of the weather table."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meteorill.functions.codes import country_name, month_name
from meteorill.functions.numbers import from_tenths

SPATIAL_SQL = """
select distinct StationId, LONGITUDE, LATITUDE, AvgPrcp
from {weather}
where FIPS_code = :fips and Year = :year and Month = :month
"""


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def top_stations(weather: DataFrame, codes: Iterable[str], n: int) -> DataFrame:
    """The first n station ids of each country.

    The rank limit is applied in each task before the shuffle, so a country with most of the
    stations sends n rows from each task.
    """
    rank = F.row_number().over(Window.partitionBy("FIPS_code").orderBy("StationId"))
    return (
        weather.filter(F.col("FIPS_code").isin(list(codes)))
        .select("FIPS_code", "StationId")
        .distinct()
        .withColumn("rank", rank)
        .filter(F.col("rank") <= n)
    )


def _of_top_stations(weather: DataFrame, codes: list[str], n: int) -> DataFrame:
    """Rows of the first n stations of each country.

    Their ids, at most n for each country, are found first, from two columns of the countries' files. As
    values of a predicate they reach the scan: row groups and pages without these stations are
    not read. As a join they would be known too late for that.
    """
    chosen = [r["StationId"] for r in top_stations(weather, codes, n).select("StationId").collect()]
    return weather.filter(F.col("FIPS_code").isin(codes) & F.col("StationId").isin(chosen))


def temporal(
    weather: DataFrame, code: str = "GM", n: int = 3, months: Iterable[int] = (1, 8)
) -> DataFrame:
    """Temperature and precipitation of n stations in the given months of every year."""
    return (
        _of_top_stations(weather, [code], n)
        .filter(F.col("Month").isin(list(months)))
        .select(
            "StationId",
            F.col("Year").alias("Y"),
            F.col("AvgPrcp").alias("PRCP"),
            F.col("AvgTmax").alias("T"),
            F.col("Month").alias("M"),
        )
        .distinct()
    )


def temporal_series(
    weather: DataFrame, code: str = "GM", n: int = 3, months: Iterable[int] = (1, 8)
) -> DataFrame:
    """`temporal` as series by year: precipitation, and temperature in degrees."""
    return (
        temporal(weather, code, n, months)
        .withColumn("T", from_tenths("T"))
        .unpivot(["StationId", "M", "Y"], ["PRCP", "T"], "measure", "value")
        .orderBy("StationId", "M", "measure", "Y")
    )


def spatial(weather: DataFrame, code: str, month: int, year: int = 2000) -> DataFrame:
    """Points of one country in one month, by a parameterised SQL query."""
    return weather.sparkSession.sql(
        SPATIAL_SQL, args={"fips": code, "month": month, "year": year}, weather=weather
    )


def spatial_slices(
    weather: DataFrame,
    codes: Iterable[str] = ("CH", "BR", "GM"),
    months: Iterable[int] = (2, 8),
    year: int = 2000,
) -> DataFrame:
    """Points of several countries and months in one query.

    All pairs are asked for, so two membership tests say it, and they reach the scan.
    """
    return (
        weather.filter(
            F.col("FIPS_code").isin(list(codes))
            & F.col("Month").isin(list(months))
            & (F.col("Year") == year)
        )
        .select(
            "FIPS_code",
            country_name().alias("country"),
            "Month",
            month_name().alias("month_name"),
            "StationId",
            "LONGITUDE",
            "LATITUDE",
            "AvgPrcp",
        )
        .distinct()
    )


def spatial_pairs(
    weather: DataFrame, pairs: Iterable[tuple[str, int]], year: int = 2000
) -> DataFrame:
    """Points for any list of (country, month) pairs given by the caller.

    Its countries and months prune the scan; Spark sizes the list for the join.
    """
    pairs = sorted(set(pairs))
    wanted = weather.sparkSession.createDataFrame(pairs, "FIPS_code string, Month int")
    return (
        weather.filter(F.col("Year") == year)
        .filter(F.col("FIPS_code").isin(sorted({code for code, _ in pairs})))
        .filter(F.col("Month").isin(sorted({month for _, month in pairs})))
        .join(wanted, ["FIPS_code", "Month"])
        .select("FIPS_code", "Month", "StationId", "LONGITUDE", "LATITUDE", "AvgPrcp")
        .distinct()
    )


def spatiotemporal(
    weather: DataFrame,
    codes: Iterable[str] = ("GM", "GR", "CH"),
    years: Iterable[int] = (1995, 1985, 1975),
) -> DataFrame:
    """Monthly precipitation of one station of each country in the given years."""
    return (
        _of_top_stations(weather, list(codes), 1)
        .filter(F.col("Year").isin(list(years)))
        .select(
            "StationId",
            F.col("Month").alias("M"),
            F.col("AvgPrcp").alias("PRCP"),
            F.col("Year").alias("Y"),
        )
        .distinct()
    )


def spatiotemporal_series(
    weather: DataFrame,
    codes: Iterable[str] = ("GM", "GR", "CH"),
    years: Iterable[int] = (1995, 1985, 1975),
) -> DataFrame:
    """`spatiotemporal` as one series for each year and station, by month."""
    return (
        spatiotemporal(weather, codes, years)
        .select("Y", "StationId", F.col("M").alias("x"), F.col("PRCP").alias("value"))
        .orderBy("Y", "StationId", "x")
    )


def temp_prcp_corr(weather: DataFrame) -> DataFrame:
    """Correlation of maximum temperature and precipitation over the years, by station and month.

    Null where one of them does not vary; `corr` itself would raise under ANSI mode.
    """
    spread = F.stddev_pop("AvgTmax") * F.stddev_pop("AvgPrcp")
    return weather.groupBy("StationId", "Month").agg(
        F.count(F.lit(1)).alias("n_years"),
        F.try_divide(F.covar_pop("AvgTmax", "AvgPrcp"), spread).alias("corr"),
    )
