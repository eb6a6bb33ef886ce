"""Text to number, units and ratios."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def slice_text(line: str, start: int, length: int) -> Column:
    return F.trim(F.substring(F.col(line), start, length))


def to_double(text: Column) -> Column:
    """Null for blank or unreadable text, also under ANSI mode."""
    return text.try_cast("double")


def from_tenths(value: str) -> Column:
    """Stored temperatures count tenths of a degree."""
    return F.col(value) / 10


def ratio(total: str, count: str) -> Column:
    """total / count, null for no count."""
    return F.try_divide(F.col(total), F.col(count))


def percent_share(part: str, whole: Column) -> Column:
    return F.round(F.col(part) * 100 / whole, 1)
