"""Observation stream to the partials or the daily table."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meteorill.operators.distinct import bit_partials, sketch_partials
from meteorill.operators.monthly import daily_values, monthly_partials
from meteorill.operators.observations import clean, parse_observations
from meteorill.operators.stations import enrich
from meteorill.schemas import DATE_FLOOR
from meteorill.sources.stream import numbered
from meteorill.sources.tables import write_bit_partials, write_daily, write_partials, write_sketch_partials
from meteorill.streaming.progress import ProgressLog, counted


def _of_batch(df: DataFrame, stream: str, epoch: int) -> DataFrame:
    return df.withColumns({"stream": F.lit(stream), "batch_id": F.lit(epoch).cast("bigint")})


def batch_partials(
    observations: DataFrame, epoch: int, stations: DataFrame, stream: str = "main"
) -> DataFrame:
    """Enriched monthly partials of one micro-batch of clean observations."""
    return _of_batch(enrich(monthly_partials(observations), stations), stream, epoch)


def _start(
    records: DataFrame, floor: int, store, checkpoint: str, trigger: dict | None, stream: str, progress: ProgressLog | None
) -> StreamingQuery:
    def run(batch: DataFrame, epoch: int) -> None:
        store(clean(parse_observations(batch, order="seq"), floor), epoch)

    arriving = counted(numbered(records)) if progress is not None else numbered(records)
    query = (
        arriving.writeStream.foreachBatch(run)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
    if progress is not None:
        progress.follow(query, stream)
    return query


def start_ingest(
    records: DataFrame,
    stations: DataFrame | Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    floor: int = DATE_FLOOR,
    trigger: dict | None = None,
    write: Callable[[DataFrame, str], None] = write_partials,
    stream: str = "main",
    progress: ProgressLog | None = None,
) -> StreamingQuery:
    """Parse, clean, aggregate and store each micro-batch as monthly partials.

    `write` has to run the batch it is given. No state is kept: late data makes one more partial row, and merging the partials gives the
    totals. A batch that is run again after a failure replaces its own directory, and `write`
    may be another sink, such as a database. Streams that share a table need different names; a
    stream that is begun anew with another checkpoint needs a new one. `progress` keeps the number of
    records and the duration of each batch.

    `stations` may be a function; then each batch asks it for the stations, and a table that has been
    published anew counts from the next batch on. Stations with a `ValidFrom` are looked up as of the month.

    The unit of the daily first value is the micro-batch: repeated values of a day that arrive in
    different ones count separately. Where that can happen, take `start_daily_ingest`.
    """

    def store(batch: DataFrame, epoch: int) -> None:
        write(batch_partials(batch, epoch, stations() if callable(stations) else stations, stream), path)

    return _start(records, floor, store, checkpoint, trigger, stream, progress)


def start_daily_ingest(
    records: DataFrame,
    path: str,
    checkpoint: str,
    floor: int = DATE_FLOOR,
    trigger: dict | None = None,
    stream: str = "main",
    progress: ProgressLog | None = None,
) -> StreamingQuery:
    """Store the first values of each micro-batch; months are made when the table is read.

    The result does not depend on how the micro-batches cut the data. The table is larger.
    """

    def store(batch: DataFrame, epoch: int) -> None:
        write_daily(_of_batch(daily_values(batch), stream, epoch), path)

    return _start(records, floor, store, checkpoint, trigger, stream, progress)


def start_distinct_ingest(
    records: DataFrame,
    path: str,
    checkpoint: str,
    exact: bool = True,
    floor: int = DATE_FLOOR,
    trigger: dict | None = None,
    stream: str = "main",
    progress: ProgressLog | None = None,
) -> StreamingQuery:
    """Store partials whose divisor is the number of distinct values: as bits, or as sketches if not `exact`.

    As with `start_ingest` the unit of the daily first value is the micro-batch.
    """

    def store(batch: DataFrame, epoch: int) -> None:
        if exact:
            write_bit_partials(_of_batch(bit_partials(batch), stream, epoch), path)
        else:
            write_sketch_partials(_of_batch(sketch_partials(batch), stream, epoch), path)

    return _start(records, floor, store, checkpoint, trigger, stream, progress)
