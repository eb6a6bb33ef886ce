"""The pipeline's inputs derived from the given tables.

`lineitem` plays the daily observations and `supplier` the stations (see FIXTURES.md).
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meteorill.operators.observations import clean
from meteorill.operators.stations import weather_from_observations
from meteorill.schemas import OBSERVATION

# Parameters for the years these tables cover.
FLOOR = 19960101
INVENTORY_YEAR = 1998
# Batches that the streams are cut into.
BATCHES = 4
#: Streams in the order of time: parts of so many months, and how late a record may be.
PART_MONTHS, PARTS, LATENESS = 18, 4, "600 days"
#: Month, counted from FLOOR, in which some stations move.
MOVE_MONTH, MOVE_DAY = 36, 19990101
SPATIAL_YEAR = 2000
SERIES_YEARS = (1996, 1998, 2000)
TOP_VARIABLES = 5

STATION_LINE = "%-11s %8.4f %9.4f %6.1f"
INVENTORY_LINE = "%-11s %8.4f %9.4f %-4s %4d %4d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(nation: str, key: str, codes: tuple[str, ...]) -> Column:
    country = F.get(F.array(*[F.lit(c) for c in codes]), F.col(nation) % len(codes))
    return F.concat(country, F.lpad(F.col(key).cast("string"), 9, "0"))


def _station_id() -> Column:
    return _id("s_nationkey", "s_suppkey", ("CH", "GM", "GR", "BR", "IS"))


def _latitude(number: Column) -> Column:
    return ((number * 37) % 1800).cast("double") / 10 - 90


def _longitude(number: Column) -> Column:
    return ((number * 53) % 3600).cast("double") / 10 - 180


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", _station_id().alias("StationId"))
    date = F.year("l_shipdate") * 10000 + F.month("l_shipdate") * 100 + F.day("l_shipdate")
    value = (F.col("l_quantity") * 10).cast("int")
    number = F.col("l_linenumber")
    variable = (
        F.when(number <= 2, "TMAX").when(number <= 4, "TMIN").when(number <= 6, "PRCP").otherwise("SNWD")
    )
    empty = F.lit(None).cast("string")
    return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "StationId",
        date.alias("Date"),
        variable.alias("Variable"),
        value.alias("Value"),
        empty.alias("M_Flag"),
        F.when(F.col("l_discount") > 0.095, "X").alias("Q_Flag"),
        empty.alias("S_Flag"),
        F.lit("0700").alias("ObsTime"),
        ((F.col("l_orderkey") * 10 + number) * 10000 + value).alias("seq"),
    )


def all_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        _station_id().alias("StationIdA"),
        _latitude(number).alias("LATITUDE"),
        _longitude(number).alias("LONGITUDE"),
        ((number * 7) % 500).cast("double").alias("ELEVATION"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine of ten suppliers, so that some observations have no station."""
    return all_stations(spark, sf_dir).filter(F.substring("StationIdA", 3, 9).cast("bigint") % 10 != 9)


def station_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stations, and for every third a line from the day on which it moved."""
    known = stations(spark, sf_dir)
    number = F.substring("StationIdA", 3, 9).cast("bigint")
    moved = known.filter(number % 3 == 0).select(
        "StationIdA", (-F.col("LATITUDE")).alias("LATITUDE"), "LONGITUDE", (F.col("ELEVATION") + 10).alias("ELEVATION"), F.lit(MOVE_DAY).alias("ValidFrom")
    )
    return known.withColumn("ValidFrom", F.lit(None).cast("int")).unionByName(moved)


def month_number() -> Column:
    """Months since FLOOR of `Date`, negative before."""
    return (F.call_function("div", "Date", F.lit(10000)) - FLOOR // 10000) * 12 + F.call_function("div", "Date", F.lit(100)) % 100 - 1


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as stations, one in six of no known country; what they ordered how as variables."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", _id("c_nationkey", "c_custkey", ("CH", "GM", "GR", "BR", "IS", "ZZ")).alias("ID")
    )
    variable = F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1), F.lit("_"), "o_orderstatus")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("ID", variable.alias("VARIABLE"))
        .agg(F.min(F.year("o_orderdate")).alias("FIRSTYEAR"), F.max(F.year("o_orderdate")).alias("LASTYEAR"))
    )


def clean_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(obs(spark, sf_dir), FLOOR)


def batched_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean observations in four logical batches that cut through months, but not days."""
    return clean_obs(spark, sf_dir).withColumn("batch_id", (F.col("Date") % BATCHES).cast("bigint"))


def weather(spark: SparkSession, sf_dir: str, divisor: str = "count") -> DataFrame:
    return weather_from_observations(clean_obs(spark, sf_dir), stations(spark, sf_dir), divisor)


def records(observations: DataFrame) -> DataFrame:
    """Observations as message-queue records: JSON in a binary value, and an offset."""
    return observations.select(
        F.to_json(F.struct(*OBSERVATION.names)).cast("binary").alias("value"),
        F.col("seq").alias("offset"),
        F.pmod(F.xxhash64("StationId"), F.lit(8)).cast("int").alias("partition"),
    )


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_stations(spark, sf_dir).select(
        F.format_string(STATION_LINE, "StationIdA", "LATITUDE", "LONGITUDE", "ELEVATION").alias("value")
    )


def inventory_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.substring("ID", 3, 9).cast("bigint")
    return inventory(spark, sf_dir).select(
        F.format_string(
            INVENTORY_LINE, "ID", _latitude(number), _longitude(number),
            "VARIABLE", "FIRSTYEAR", "LASTYEAR",
        ).alias("value")
    )
