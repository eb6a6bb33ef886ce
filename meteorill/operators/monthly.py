"""Daily values to monthly sums and averages.

Each step is a hash aggregation with a map-side part, so a station or month that holds a large
share of the rows reaches a task only as one buffer from each upstream task.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meteorill.functions.dates import month_of, year_of
from meteorill.functions.numbers import ratio
from meteorill.schemas import VARIABLES

# Column suffix of each variable in the monthly tables.
SUFFIX = {"TMAX": "Tmax", "TMIN": "Tmin", "PRCP": "Prcp"}
SUMS = [f"Sum{s}" for s in SUFFIX.values()]
COUNTS = [f"count{s}" for s in SUFFIX.values()]
AVERAGES = [f"Avg{s}" for s in SUFFIX.values()]

DIVISORS = ("count", "distinct", "approx_distinct")


def _is(variable: str) -> Column:
    return F.col("Variable") == variable


def of_batch(df: DataFrame) -> list[str]:
    """`batch_id` takes part in the grouping where the input carries it."""
    return ["batch_id"] if "batch_id" in df.columns else []


def _order(df: DataFrame) -> str:
    """First by `seq`; input without it takes the lowest value, which is as repeatable."""
    return "seq" if "seq" in df.columns else "Value"


def daily_pivot(observations: DataFrame) -> DataFrame:
    """One row for each station and day with a column for each variable.

    The variables are given, so all columns are there whatever the input holds, and no job
    runs to find them. One aggregation does it; `pivot` would plan two.
    """
    order = _order(observations)
    first = [
        F.min_by(F.when(_is(v), F.col("Value")), F.when(_is(v), F.col(order))).alias(v)
        for v in VARIABLES
    ]
    return observations.groupBy(*of_batch(observations), "StationId", "Date").agg(*first)


def daily_values(observations: DataFrame) -> DataFrame:
    """The long form of `daily_pivot`: one row for each station, day and variable.

    Its rows are observations again, with the `seq` of the first value where there is one.
    """
    order = _order(observations)
    kept = [F.min(order).alias("seq")] if order == "seq" else []
    return observations.groupBy(*of_batch(observations), "StationId", "Date", "Variable").agg(
        F.min_by("Value", order).alias("Value"), *kept
    )


def with_month(daily: DataFrame) -> DataFrame:
    return daily.withColumns({"Month": month_of(), "Year": year_of()})


def monthly_partials(observations: DataFrame, divisor: str = "count") -> DataFrame:
    """Sums and divisors for each station and month (and batch).

    divisor: `count` counts days, which makes a true mean that merges over batches.
    `distinct` counts distinct values, `approx_distinct` estimates that number. Such numbers do not merge, so
    input that carries batches is refused here; `distinct.bit_partials` and `distinct.sketch_partials`
    keep what does.
    """
    if divisor not in DIVISORS:
        raise ValueError(f"divisor must be one of {DIVISORS}")
    if divisor != "count" and of_batch(observations):
        raise ValueError(f"divisor {divisor!r} cannot be merged over batches")
    keys = [*of_batch(observations), "StationId", "Month", "Year"]

    if divisor == "distinct":
        # Counting values before months keeps one row for each value; several
        # count(distinct ...) side by side would multiply the rows instead.
        values = (
            with_month(daily_values(observations))
            .groupBy(*keys, "Variable", "Value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        total = {v: F.sum(F.when(_is(v), F.col("Value") * F.col("n"))) for v in VARIABLES}
        count = {v: F.count(F.when(_is(v), F.col("Value"))) for v in VARIABLES}
        source = values
    else:
        total = {v: F.sum(v) for v in VARIABLES}
        count = {v: F.count(v) for v in VARIABLES}
        source = with_month(daily_pivot(observations))
        if divisor == "approx_distinct":
            # An estimate's buffer is many times a day's row. Over a window there is one buffer at a time, of one
            # month; a hash aggregation would hold, and shuffle, one for each month in every task.
            month = Window.partitionBy(*keys)
            source = source.withColumns({COUNTS[k]: F.approx_count_distinct(v).over(month) for k, v in enumerate(VARIABLES)})
            count = {v: F.max(COUNTS[k]) for k, v in enumerate(VARIABLES)}

    return source.groupBy(*keys).agg(
        *[total[v].alias(f"Sum{SUFFIX[v]}") for v in VARIABLES],
        *[count[v].alias(f"count{SUFFIX[v]}") for v in VARIABLES],
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """Partial sums of all batches to one row for each station and month.

    Coordinates that the partials carry play no part: they may have come or changed in between.
    """
    return partials.groupBy("StationId", "Month", "Year").agg(
        *[F.sum(c).alias(c) for c in [*SUMS, *COUNTS]]
    )


def monthly_averages(merged: DataFrame) -> DataFrame:
    """Averages of the months that have all of them."""
    others = [c for c in merged.columns if c not in (*SUMS, *COUNTS)]
    averages = [ratio(s, c).alias(a) for s, c, a in zip(SUMS, COUNTS, AVERAGES, strict=True)]
    return merged.select(*others, *averages).dropna(subset=AVERAGES)
