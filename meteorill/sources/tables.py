"""The tables of the pipeline, kept as Parquet.

`partials`, `daily`, `monthly` and `progress` have one directory for each micro-batch of each stream, so that
a batch that runs again replaces what it wrote before, and no other stream's. `weather` and the compacted partials are
published as whole versions; `weather` has one directory for each country, so that country predicates
prune files.
"""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meteorill.operators.monthly import COUNTS, SUMS
from meteorill.schemas import BIT_PARTIALS, COORDINATES, DAILY, MONTHLY, PARTIALS, PROGRESS, SKETCH_PARTIALS, WEATHER
from meteorill.sources import snapshots


def _write_batches(df: DataFrame, schema: StructType, path: str) -> None:
    (
        df.select(schema.names)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("stream", "batch_id")
        .parquet(path)
    )


def _read(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    # The schema is given: no files are opened to find it, and an empty table has it too.
    return spark.read.schema(schema).parquet(path).select(schema.names)


def write_partials(partials: DataFrame, path: str) -> None:
    _write_batches(partials, PARTIALS, path)


def read_partials(spark: SparkSession, path: str, compacted: str | None = None) -> DataFrame:
    """Partials of all batches; those that the table at `compacted` covers come from there."""
    batches = _read(spark, PARTIALS, path)
    if compacted is None:
        return batches
    old = snapshots.read(spark, PARTIALS, compacted)
    # One row for each stream.
    covered = old.groupBy("stream").agg(F.max("batch_id").alias("covered"))
    new = batches.join(covered, "stream", "left").filter("covered is null or batch_id > covered")
    return old.unionByName(new.select(PARTIALS.names))


def compact_partials(spark: SparkSession, path: str, compacted: str, up_to: int | Mapping[str, int]) -> None:
    """Publish the merged batches of every stream up to `up_to`, which must be closed, as the next version of `compacted`.

    `up_to` is one number, or one for each stream; streams that it does not name stay as they are. Merged rows
    have the number of the stream's last merged batch. Doing it again, or a late replay of a covered
    batch, changes nothing for readers: what lies at or below that number is read from the
    version only. Folders of batches that the version before covered already are deleted, so that a
    reader that has not seen the new version still finds all it needs.
    """
    covered = {r["stream"]: r["last"] for r in snapshots.read(spark, PARTIALS, compacted).groupBy("stream").agg(F.max("batch_id").alias("last")).collect()}
    everything = read_partials(spark, path, compacted)
    if isinstance(up_to, Mapping):
        known = list(up_to.items())
        limit = F.lit(None).cast("bigint")
        for name, last in known:
            limit = F.when(F.col("stream") == name, F.lit(last)).otherwise(limit)
    else:
        limit = F.lit(up_to)
    before = F.lit(None).cast("bigint")
    for name, last in covered.items():
        before = F.when(F.col("stream") == name, F.lit(last)).otherwise(before)
    closed = everything.filter((F.col("batch_id") <= limit) | (F.col("batch_id") <= before))
    keys = ["stream", "StationId", "Month", "Year"]
    place = F.max(F.struct("batch_id", "FIPS_code", *COORDINATES)).alias("place")
    merged = closed.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (*SUMS, *COUNTS)], place)
    last = closed.groupBy("stream").agg(F.max("batch_id").alias("batch_id"))
    columns = [*keys, *SUMS, *COUNTS, "place.FIPS_code", *[f"place.{c}" for c in COORDINATES]]
    snapshots.publish(merged.select(*columns).join(last, "stream").select(PARTIALS.names), compacted)
    _drop_batches(spark, path, covered)


def _drop_batches(spark: SparkSession, path: str, covered: Mapping[str, int]) -> None:
    folder = snapshots.Folder(spark, path)
    for stream, last in covered.items():
        for name in folder.names(f"stream={stream}"):
            if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= last:
                folder.delete(f"stream={stream}/{name}")


def write_sketch_partials(partials: DataFrame, path: str) -> None:
    _write_batches(partials, SKETCH_PARTIALS, path)


def read_sketch_partials(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, SKETCH_PARTIALS, path)


def write_bit_partials(partials: DataFrame, path: str) -> None:
    _write_batches(partials, BIT_PARTIALS, path)


def read_bit_partials(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, BIT_PARTIALS, path)


def write_daily(daily: DataFrame, path: str) -> None:
    _write_batches(daily, DAILY, path)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, DAILY, path)


def write_monthly(monthly: DataFrame, path: str) -> None:
    _write_batches(monthly, MONTHLY, path)


def read_monthly(spark: SparkSession, path: str) -> DataFrame:
    """The latest sums of each station and month; streams add up."""
    values = [*SUMS, *COUNTS]
    latest = F.max_by(F.struct(*values), "batch_id").alias("latest")
    kept = _read(spark, MONTHLY, path).groupBy("stream", "StationId", "Month", "Year").agg(latest)
    return kept.select("stream", "StationId", "Month", "Year", *[f"latest.{c}" for c in values])


def write_progress(progress: DataFrame, path: str) -> None:
    _write_batches(progress, PROGRESS, path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, PROGRESS, path)


def write_weather(weather: DataFrame, path: str, files: int | None = None, row_group: int | None = None) -> None:
    """Publish the next version of the table: readers have the one before or this one.

    Rows lie by country and station, so that a file and a row group hold few stations, and in them by year and month.
    Statistics and Bloom filters of the stations let readers skip the rest. A country that holds much
    of the table is cut into ranges of stations. `files` and `row_group` (bytes) are left to Spark if not given.
    """
    order = ["FIPS_code", "StationId"]
    ranged = weather.select(WEATHER.names).repartitionByRange(*([files] if files else []), *order)
    options = {"parquet.bloom.filter.enabled#StationId": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
    if row_group:
        options["parquet.block.size"] = str(row_group)
    snapshots.publish(ranged.sortWithinPartitions(*order, "Year", "Month"), path, lambda w: w.options(**options).partitionBy("FIPS_code"))


def read_weather(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return snapshots.read(spark, WEATHER, path, version)
