"""The observation stream."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meteorill.schemas import COUNTRIES


def kafka_options(
    servers: str,
    topics: Iterable[str] = tuple(COUNTRIES),
    max_offsets: int | None = None,
    starting: str = "earliest",
) -> dict[str, str]:
    """Reader options: one topic for each country, read from the start.

    `max_offsets` caps the records of a trigger, 500,000 for instance; without it a stream that is
    behind catches up in one batch.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def admitted(files: int | None = None, size: int | None = None) -> dict[str, str]:
    """Reader options of a file stream: most files, and most bytes, of a micro-batch.

    A stream that is behind then catches up in bounded batches, in the order in which the files were
    written, also where it takes all there is and ends (`availableNow`). A file is not cut.
    """
    if files is not None and size is not None:
        raise ValueError("a file stream is limited by files or by bytes, not by both")
    if files is not None:
        return {"maxFilesPerTrigger": str(files)}
    return {"maxBytesPerTrigger": str(size)} if size is not None else {}


def observation_stream(
    spark: SparkSession,
    options: Mapping[str, str],
    source: str = "kafka",
    schema: StructType | None = None,
    path: str | None = None,
) -> DataFrame:
    """Raw records with a `value` column; any streaming source of such records will do."""
    reader = spark.readStream.format(source).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


#: Bits of `seq` that hold the record's partition.
PARTITION_BITS = 12


def numbered(records: DataFrame) -> DataFrame:
    """Add `seq` from a record's offset and partition: offsets alone repeat across partitions."""
    offset = F.shiftleft(F.col("offset").cast("bigint"), PARTITION_BITS)
    if "partition" not in records.columns:
        return records.withColumn("seq", offset)
    return records.withColumn("seq", offset + F.coalesce("partition", F.lit(0)) % (1 << PARTITION_BITS))
