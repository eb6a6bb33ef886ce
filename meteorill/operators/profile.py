"""Which stations and variables the countries have, from the inventory."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meteorill.functions.codes import country_name, fips_code, is_station_of
from meteorill.functions.numbers import percent_share
from meteorill.schemas import COUNTRIES


def inventory_recent(inventory: DataFrame, year: int = 1970) -> DataFrame:
    """Entries that begin in `year` or later, or end after it."""
    return inventory.filter((F.col("FIRSTYEAR") >= year) | (F.col("LASTYEAR") > year))


def country_table(spark: SparkSession, countries: Mapping[str, str] = COUNTRIES) -> DataFrame:
    return spark.createDataFrame(list(countries.items()), "FIPS string, country string")


def _of_countries(inventory: DataFrame, codes: Iterable[str]) -> DataFrame:
    return inventory.filter(is_station_of(codes)).withColumn("FIPS", fips_code("ID"))


def stations_per_country(
    inventory: DataFrame, countries: Mapping[str, str] = COUNTRIES
) -> DataFrame:
    """Number of stations of each country, 0 for a country without any."""
    counts = (
        _of_countries(inventory, countries)
        .groupBy("FIPS")
        .agg(F.countDistinct("ID").alias("n_stations"))
    )
    # At most one row for each country on either side.
    return (
        country_table(inventory.sparkSession, countries)
        .join(F.broadcast(counts), "FIPS", "left")
        .fillna(0, subset=["n_stations"])
    )


def variable_counts(inventory: DataFrame, codes: Iterable[str] = tuple(COUNTRIES)) -> DataFrame:
    return (
        _of_countries(inventory, codes)
        .groupBy("FIPS", "VARIABLE")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_variables(
    inventory: DataFrame, k: int = 5, codes: Iterable[str] = tuple(COUNTRIES)
) -> DataFrame:
    """The k most frequent variables of each country; ties go by name."""
    rank = F.row_number().over(Window.partitionBy("FIPS").orderBy(F.desc("n"), "VARIABLE"))
    return (
        variable_counts(inventory, codes)
        .withColumn("rank", rank)
        .filter(F.col("rank") <= k)
    )


def variable_share(
    inventory: DataFrame, k: int = 5, codes: Iterable[str] = tuple(COUNTRIES)
) -> DataFrame:
    """Share of each of a country's top variables among them, with a two-line label."""
    total = F.sum("n").over(Window.partitionBy("FIPS"))
    return (
        top_variables(inventory, k, codes)
        .withColumn("pct", percent_share("n", total))
        .withColumn("country", country_name("FIPS"))
        .withColumn(
            "label",
            F.concat(
                F.col("pct").cast("decimal(4,1)").cast("string"),
                F.lit("%\n("),
                F.col("n").cast("string"),
                F.lit(")"),
            ),
        )
        .drop("rank")
    )
