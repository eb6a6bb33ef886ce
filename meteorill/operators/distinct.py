"""Divisors by distinct values that merge over batches, as sketches or as sets of bits.

Counts of distinct values cannot be added up: a value that two batches hold would count twice. What
is kept for each month instead is something that knows which values were there:

* a sketch for each variable (`sketch_partials`). Its size is bounded, and so is its error: up to some 380
  distinct values it holds their hashes and counts them (two of them are taken for one with a chance of
  about one in 60 million), beyond that the standard error is 1.6 percent. A month has at most 31.
* one row for each variable and 64 neighbouring values (`bit_partials`), with a bit for each of them.
  It is exact, and merged by `bit_or` in hash aggregations with generated code.

Both carry the sums, so that one table gives the averages. Merging in any order, again, or with an empty
partial gives the same. Months of batches that come late are merged like all others.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteorill.operators.monthly import COUNTS, SUFFIX, SUMS, daily_pivot, daily_values, of_batch, with_month
from meteorill.schemas import VARIABLES

SKETCHES = [f"Sketch{s}" for s in SUFFIX.values()]
MONTH = ["StationId", "Month", "Year"]
#: Values that share a row of bits.
WORD = 64


def sketch_partials(observations: DataFrame) -> DataFrame:
    """Sums and a sketch of the distinct values for each station and month (and batch)."""
    sums = [F.sum(v).alias(s) for v, s in zip(VARIABLES, SUMS, strict=True)]
    sketches = [F.hll_sketch_agg(v).alias(s) for v, s in zip(VARIABLES, SKETCHES, strict=True)]
    return with_month(daily_pivot(observations)).groupBy(*of_batch(observations), *MONTH).agg(*sums, *sketches)


def merge_sketches(partials: DataFrame) -> DataFrame:
    """One row of the same columns for each station and month."""
    sums, sketches = [F.sum(c).alias(c) for c in SUMS], [F.hll_union_agg(c).alias(c) for c in SKETCHES]
    return partials.groupBy(*MONTH).agg(*sums, *sketches)


def counted_sketches(merged: DataFrame) -> DataFrame:
    """Estimates in the columns of the counts."""
    counts = [F.coalesce(F.hll_sketch_estimate(s), F.lit(0).cast("bigint")).alias(c) for s, c in zip(SKETCHES, COUNTS, strict=True)]
    return merged.select(*[c for c in merged.columns if c not in SKETCHES], *counts)


def bit_partials(observations: DataFrame) -> DataFrame:
    """(StationId, Month, Year, Variable, Word, Bits, Total): the bits of the values from 64 * Word on that
    occurred in a month (and batch), and the sum of all days with such values.
    """
    value = F.col("Value")
    known = with_month(daily_values(observations)).where(value.isNotNull())
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(value, F.lit(WORD)))
    keys = [*of_batch(observations), *MONTH, "Variable", F.floor(value / WORD).cast("int").alias("Word")]
    return known.groupBy(*keys).agg(F.bit_or(bit).alias("Bits"), F.sum("Value").alias("Total"))


def merge_bits(partials: DataFrame) -> DataFrame:
    """One row of the same columns for each station, month, variable and word."""
    return partials.groupBy(*MONTH, "Variable", "Word").agg(F.bit_or("Bits").alias("Bits"), F.sum("Total").alias("Total"))


def counted_bits(merged: DataFrame) -> DataFrame:
    """Sums and numbers of distinct values, one row for each station and month."""

    def of(variable: str, value: Column) -> Column:
        return F.sum(F.when(F.col("Variable") == variable, value))

    totals = [of(v, F.col("Total")).alias(s) for v, s in zip(VARIABLES, SUMS, strict=True)]
    counts = [F.coalesce(of(v, F.bit_count("Bits")), F.lit(0).cast("bigint")).alias(c) for v, c in zip(VARIABLES, COUNTS, strict=True)]
    return merged.groupBy(*MONTH).agg(*totals, *counts)
