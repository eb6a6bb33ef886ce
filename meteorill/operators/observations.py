"""Raw records to clean observations; the same functions serve batch and stream."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteorill.schemas import DATE_FLOOR, OBSERVATION, VARIABLES


def parse_observations(records: DataFrame, value: str = "value", order: str | None = None) -> DataFrame:
    """JSON records to observation columns.

    `order` names a column of the record, such as its offset; it is kept as `seq` and decides
    which of several values of a station, day and variable is the first one. It should differ
    between a station's records, as the offset does when messages are keyed by station.
    """
    kept = [F.col(order).alias("seq")] if order else []
    observation = F.from_json(F.col(value).cast("string"), OBSERVATION)
    # `inline` rather than `json.*`: filters on its columns stay above it. Pushed below a
    # projection, each of them would parse the record once more.
    return records.select(F.inline(F.array(observation)), *kept)


def clean(
    observations: DataFrame,
    floor: int = DATE_FLOOR,
    variables: Iterable[str] = VARIABLES,
) -> DataFrame:
    """Observations from `floor` on that passed the quality check, of the given variables."""
    kept = ["StationId", "Date", "Variable", "Value"]
    kept += [c for c in observations.columns if c in ("seq", "batch_id")]
    return observations.filter(
        (F.col("Date") >= floor)
        & F.col("Q_Flag").isNull()
        & F.col("Variable").isin(list(variables))
    ).select(kept)
