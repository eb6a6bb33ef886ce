"""Station and inventory text files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteorill.functions.numbers import slice_text, to_double


def parse_stations(lines: DataFrame) -> DataFrame:
    """Fixed-width lines in `value`: id 1-11, latitude 12-20, longitude 22-30, elevation 32-40."""
    return lines.select(
        slice_text("value", 1, 11).alias("StationIdA"),
        to_double(slice_text("value", 12, 9)).alias("LATITUDE"),
        to_double(slice_text("value", 22, 9)).alias("LONGITUDE"),
        to_double(slice_text("value", 32, 9)).alias("ELEVATION"),
    )


def parse_inventory(lines: DataFrame) -> DataFrame:
    """Six fields set apart by blanks: one line for each station and variable."""
    field = F.split(F.trim("value"), r"\s+")
    return lines.select(
        F.get(field, F.lit(0)).alias("ID"),
        to_double(F.get(field, F.lit(1))).alias("LATITUDE"),
        to_double(F.get(field, F.lit(2))).alias("LONGITUDE"),
        F.get(field, F.lit(3)).alias("VARIABLE"),
        F.get(field, F.lit(4)).try_cast("int").alias("FIRSTYEAR"),
        F.get(field, F.lit(5)).try_cast("int").alias("LASTYEAR"),
    )


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return parse_stations(spark.read.text(path))


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    return parse_inventory(spark.read.text(path))
