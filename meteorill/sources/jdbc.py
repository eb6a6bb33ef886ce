"""Database tables as an alternative to the Parquet ones.

Address and credentials are the caller's arguments; nothing is kept here.
"""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str, table: str, user: str | None = None, password: str | None = None, **more
) -> dict[str, str]:
    options = {"url": url, "dbtable": table}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    options.update({key: str(value) for key, value in more.items()})
    return options


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    years: tuple[int, int] | None = None,
    partitions: int = 64,
) -> DataFrame:
    """Scan a table; with `years` the scan is cut by Year into parallel range queries."""
    reader = spark.read.format("jdbc").options(**options)
    if years is not None:
        reader = reader.options(
            partitionColumn="Year",
            lowerBound=str(years[0]),
            upperBound=str(years[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


def without_replays(partials: DataFrame) -> DataFrame:
    """Partials of a table that sinks append to: a batch that ran again counts once."""
    return partials.dropDuplicates(["stream", "batch_id", "StationId", "Month", "Year"])


def write_jdbc(df: DataFrame, options: Mapping[str, str], mode: str = "append") -> None:
    df.write.format("jdbc").mode(mode).options(**options).save()
