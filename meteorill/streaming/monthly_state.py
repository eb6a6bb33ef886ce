"""Monthly sums kept up to date by a stateful stream.

The state has the first value of each station, day and variable, by the records' order in
the whole stream. Stations are dealt into `BUCKETS` groups by their hash, and there is one state for each group and year,
which is updated for all its stations at once. Whenever a batch changes a value, the sums of its month go out again (output mode `update`), and the
sink keeps the latest row of each month. A day that is cut over batches, or whose first record comes last,
counts once and right; no table of daily values is needed.

What the state holds is bounded: 366 days and three variables for each station and year, until the watermark passes the
year's end. Records that are older than the watermark are dropped. Before the shuffle each task reduces its
records to the first of each station, day and variable, so that a station with a large share of the records
sends no more rows than it has days.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from meteorill.operators.monthly import COUNTS, SUMS
from meteorill.operators.observations import clean, parse_observations
from meteorill.schemas import DATE_FLOOR, VARIABLES
from meteorill.sources.stream import numbered
from meteorill.sources.tables import write_monthly
from meteorill.streaming.progress import ProgressLog, counted

LATENESS = "100 days"
#: Groups that the stations of a year are dealt into. Calling Python for a group costs much more than a station's rows, so
#: that a group for each station would make the calls the most of the time.
BUCKETS = 1024
FIRST = ["StationId", "Date", "Variable"]
FIRST_SCHEMA = "StationId string, Date int, Variable string, Value bigint, seq bigint"
#: Stations of a group, and as 64-bit numbers: the place of a value (station, day and variable), the order of its record,
#: and the value; a missing one is the least number.
STATE_SCHEMA = "stations array<string>, places binary, seqs binary, amounts binary"
#: Places of a station: more than the last day and variable have.
PLACES = 4096
MISSING = np.iinfo(np.int64).min
OUT_SCHEMA = ", ".join(["StationId string", "Month int", "Year int", *[f"{c} bigint" for c in (*SUMS, *COUNTS)]])


def first_of_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first row of each station, day and variable in each portion of a task's rows."""
    for rows in batches:
        yield rows.sort_values("seq", kind="stable").drop_duplicates(FIRST)


def _merged(places: np.ndarray, seqs: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first of each place, by place."""
    order = np.lexsort((seqs, places))
    places, seqs, amounts = places[order], seqs[order], amounts[order]
    first = np.flatnonzero(np.diff(places, prepend=-1))
    return places[first], seqs[first], amounts[first]


def _months(places: np.ndarray) -> np.ndarray:
    """Station and month of each place as one number."""
    return places // PLACES * 100 + places % PLACES // len(VARIABLES) // 100


def monthly_sums(places: np.ndarray, amounts: np.ndarray, months: np.ndarray, stations: list[str]) -> pd.DataFrame:
    """Sums and counts of the months with these numbers, which ascend."""
    of = _months(places)
    at = np.minimum(np.searchsorted(months, of), len(months) - 1)
    known = (amounts != MISSING) & (months[at] == of)
    out = {"StationId": [stations[m // 100] for m in months.tolist()], "Month": months % 100}
    for number, (total, count) in enumerate(zip(SUMS, COUNTS, strict=True)):
        own = known & (places % PLACES % len(VARIABLES) == number)
        sums, counts = np.zeros(len(months), dtype=np.int64), np.bincount(at[own], minlength=len(months))
        np.add.at(sums, at[own], amounts[own])
        out[total], out[count] = pd.arrays.IntegerArray(sums, counts == 0), counts
    return pd.DataFrame(out)


def update_year(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The changed months of a group of stations in one year."""
    year = int(key[1])
    if state.hasTimedOut:
        state.remove()
        return
    stations, *kept = state.get if state.exists else ([], b"", b"", b"")
    places, seqs, amounts = (np.frombuffer(x, dtype=np.int64) for x in kept)
    before, number = (places, amounts), {s: k for k, s in enumerate(stations)}
    for rows in batches:
        codes, names = pd.factorize(rows["StationId"])
        owner = np.array([number.setdefault(s, len(number)) for s in names], dtype=np.int64)[codes]
        day = rows["Date"].to_numpy() % 10000
        place = owner * PLACES + day * len(VARIABLES) + rows["Variable"].map({v: k for k, v in enumerate(VARIABLES)}).to_numpy()
        value = rows["Value"].astype("Int64")
        amount = value.fillna(0).to_numpy(dtype=np.int64)
        amount[value.isna().to_numpy()] = MISSING
        places, seqs, amounts = _merged(*(np.concatenate(x) for x in ((places, place), (seqs, rows["seq"].to_numpy()), (amounts, amount))))
    state.update((list(number), places.tobytes(), seqs.tobytes(), amounts.tobytes()))
    end = int(pd.Timestamp(year=year + 1, month=1, day=1, tz="UTC").timestamp() * 1000)
    state.setTimeoutTimestamp(max(end, state.getCurrentWatermarkMs() + 1))
    same = np.zeros(len(places), dtype=bool)
    if len(before[0]):
        at = np.minimum(np.searchsorted(before[0], places), len(before[0]) - 1)
        same = (before[0][at] == places) & (before[1][at] == amounts)
    if not same.all():
        sums = monthly_sums(places, amounts, np.unique(_months(places[~same])), list(number))
        sums.insert(2, "Year", year)
        yield sums


def monthly_updates(observations: DataFrame, lateness: str = LATENESS, buckets: int = BUCKETS) -> DataFrame:
    """A stream of the months that change, from a stream of clean observations with `seq`.

    A checkpoint belongs to the number of `buckets` it was begun with.
    """
    observed = observations.select("StationId", "Date", "Variable", F.col("Value").cast("bigint").alias("Value"), "seq").where("StationId is not null and Date is not null")
    first = observed.mapInPandas(first_of_task, FIRST_SCHEMA)
    day = F.try_to_timestamp(F.col("Date").cast("string"), F.lit("yyyyMMdd"))
    bucket = F.pmod(F.xxhash64("StationId"), F.lit(buckets)).cast("int")
    dated = first.withColumns({"Day": day, "Year": F.call_function("div", "Date", F.lit(10000)).cast("int"), "Bucket": bucket}).where("Day is not null")
    return (
        dated.withWatermark("Day", lateness)
        .groupBy("Bucket", "Year")
        .applyInPandasWithState(update_year, OUT_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.EventTimeTimeout)
    )


def start_monthly_state(
    records: DataFrame,
    path: str,
    checkpoint: str,
    floor: int = DATE_FLOOR,
    trigger: dict | None = None,
    stream: str = "main",
    progress: ProgressLog | None = None,
    lateness: str = LATENESS,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keep the monthly sums in the table at `path` up to date; `tables.read_monthly` gives the latest."""

    def upsert(batch: DataFrame, epoch: int) -> None:
        write_monthly(batch.withColumns({"stream": F.lit(stream), "batch_id": F.lit(epoch).cast("bigint")}), path)

    arriving = counted(numbered(records)) if progress is not None else numbered(records)
    updates = monthly_updates(clean(parse_observations(arriving, order="seq"), floor), lateness, buckets)
    query = (
        updates.writeStream.foreachBatch(upsert)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
    if progress is not None:
        progress.follow(query, stream)
    return query
