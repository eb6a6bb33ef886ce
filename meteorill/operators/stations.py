"""Station coordinates and the published weather table."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meteorill.functions.codes import fips_code
from meteorill.operators.distinct import counted_bits, counted_sketches, merge_bits, merge_sketches
from meteorill.operators.monthly import merge_partials, monthly_averages, monthly_partials
from meteorill.schemas import COORDINATES, WEATHER


def one_per_station(stations: DataFrame) -> DataFrame:
    """One line for each id: of several, the one with the greatest coordinates, known ones first."""
    line = F.max(F.struct(*COORDINATES)).alias("line")
    return stations.groupBy("StationIdA").agg(line).select("StationIdA", "line.*")


def periods(history: DataFrame) -> DataFrame:
    """Stations with the day (as a number, yyyymmdd) from which a line is valid, and that of the next line.

    Of several lines from one day that of the greatest coordinates counts. A missing day is the beginning of time.
    """
    start = F.coalesce("ValidFrom", F.lit(0)).alias("ValidFrom")
    lines = history.groupBy("StationIdA", start).agg(F.max(F.struct(*COORDINATES)).alias("line"))
    following = F.lead("ValidFrom").over(Window.partitionBy("StationIdA").orderBy("ValidFrom"))
    return lines.select("StationIdA", "ValidFrom", following.alias("ValidTo"), "line.*")


def enrich_as_of(monthly: DataFrame, history: DataFrame) -> DataFrame:
    """`enrich` with the coordinates that were valid at the end of each month; before its first line a station has none.

    The join is on the station, and of its periods one fits: no month is multiplied.
    """
    last_day = F.col("Year") * 10000 + F.col("Month") * 100 + 31
    valid = (last_day >= F.col("ValidFrom")) & (F.col("ValidTo").isNull() | (last_day < F.col("ValidTo")))
    return (
        monthly.withColumn("FIPS_code", fips_code())
        .join(periods(history), (F.col("StationId") == F.col("StationIdA")) & valid, "left")
        .drop("StationIdA", "ValidFrom", "ValidTo")
    )


def enrich(monthly: DataFrame, stations: DataFrame) -> DataFrame:
    """Add country code and coordinates; an unknown station keeps its rows with nulls.

    Repeated station lines are reduced to one first. Stations with a `ValidFrom` are looked up as of the month.

    No broadcast hint: Spark broadcasts the stations when their size is under
    `spark.sql.autoBroadcastJoinThreshold` and sort-merges beyond it, where AQE splits a hot
    station.
    """
    if "ValidFrom" in stations.columns:
        return enrich_as_of(monthly, stations)
    return (
        monthly.withColumn("FIPS_code", fips_code())
        .join(one_per_station(stations), F.col("StationId") == F.col("StationIdA"), "left")
        .drop("StationIdA")
    )


def weather_from_observations(
    observations: DataFrame, stations: DataFrame, divisor: str = "count"
) -> DataFrame:
    """Clean observations to the weather table in one batch job.

    Coordinates are joined last, to the fewest rows.
    """
    averages = monthly_averages(monthly_partials(observations, divisor))
    return enrich(averages, stations).select(WEATHER.names)


def weather_from_partials(partials: DataFrame, stations: DataFrame) -> DataFrame:
    """Partials of all micro-batches to the weather table, with the stations as they are now."""
    return enrich(monthly_averages(merge_partials(partials)), stations).select(WEATHER.names)


def weather_from_sketches(partials: DataFrame, stations: DataFrame) -> DataFrame:
    """Partials with sketches of all micro-batches to the weather table, divided by estimates of the distinct values."""
    return enrich(monthly_averages(counted_sketches(merge_sketches(partials))), stations).select(WEATHER.names)


def weather_from_bits(partials: DataFrame, stations: DataFrame) -> DataFrame:
    """Partials with bits of all micro-batches to the weather table, divided by the number of distinct values."""
    return enrich(monthly_averages(counted_bits(merge_bits(partials))), stations).select(WEATHER.names)


def weather_from_daily(daily: DataFrame, stations: DataFrame, divisor: str = "count") -> DataFrame:
    """First values by micro-batch to the weather table.

    The first of a day's values over all batches counts, however the batches cut the day.
    """
    return weather_from_observations(daily.drop("stream", "batch_id"), stations, divisor)


def weather_from_monthly(monthly: DataFrame, stations: DataFrame) -> DataFrame:
    """The sums of a stateful stream to the weather table."""
    return enrich(monthly_averages(merge_partials(monthly)), stations).select(WEATHER.names)
