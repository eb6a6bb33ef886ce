"""Split, labels and feature vectors for the models."""

from collections.abc import Iterable

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteorill.functions.codes import season
from meteorill.schemas import COORDINATES

# The models' columns, in the order of the feature vector.
TEMPERATURES = ("AvgTmin", "AvgTmax")
REGRESSION_SCALARS = ("Month", "Year", "AvgTmin", "AvgTmax", "LONGITUDE", "LATITUDE", "ELEVATION")
FOREST_SCALARS = ("AvgPrcp", "AvgTmin", "AvgTmax", "Year")


#: Values of the four hexadecimal digits that a row's bucket comes from.
HASH_VALUES = 1 << 16


def _row_key() -> Column:
    return F.concat_ws("|", "StationId", "Year", "Month")


def row_bucket(buckets: int) -> Column:
    """A bucket for each station and month that depends on nothing but these."""
    if not 0 < buckets <= HASH_VALUES:
        raise ValueError(f"buckets must be from 1 to {HASH_VALUES}")
    number = F.conv(F.substring(F.md5(_row_key()), 1, 4), 16, 10).cast("int")
    return number % buckets


def with_split(df: DataFrame, train_tenths: int = 7) -> DataFrame:
    """Add `split`: train for about 70% of the rows, test for the others.

    The split comes from the row's key, so it is the same on any partitioning and when a lost
    task is run again.
    """
    return df.withColumn(
        "split", F.when(row_bucket(10) < train_tenths, "train").otherwise("test")
    )


def with_season(df: DataFrame) -> DataFrame:
    return df.withColumn("Season", season())


def incomplete_rows(df: DataFrame, columns: Iterable[str] = REGRESSION_SCALARS) -> DataFrame:
    """How many rows of each country the models cannot use because a feature is missing."""
    missing = F.lit(False)
    for column in columns:
        missing = missing | F.col(column).isNull()
    return df.groupBy("FIPS_code").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(missing, 1)).alias("n_incomplete"),
    )


def country_encoder() -> list:
    """Country code to index (most frequent first) to one-hot vector (last one dropped).

    Rows without a code are skipped.
    """
    return [
        StringIndexer(inputCol="FIPS_code", outputCol="FIPS_index", handleInvalid="skip"),
        OneHotEncoder(inputCol="FIPS_index", outputCol="FIPS_vec"),
    ]


def regression_vector(with_temperature: bool = True, output: str = "features") -> VectorAssembler:
    """Scalars and the encoded country as one vector; rows with a missing scalar are skipped."""
    scalars = [c for c in REGRESSION_SCALARS if with_temperature or c not in TEMPERATURES]
    return VectorAssembler(inputCols=[*scalars, "FIPS_vec"], outputCol=output, handleInvalid="skip")


def regression_features(with_temperature: bool = True) -> Pipeline:
    return Pipeline(stages=[*country_encoder(), regression_vector(with_temperature)])


def location_features(scalars: Iterable[str] = FOREST_SCALARS, more: Iterable[str] = ()) -> list:
    """A location vector, and the feature vector that takes it in."""
    return [
        VectorAssembler(
            inputCols=list(COORDINATES), outputCol="Location", handleInvalid="skip"
        ),
        VectorAssembler(
            inputCols=[*scalars, "Location", *more], outputCol="features", handleInvalid="skip"
        ),
    ]
