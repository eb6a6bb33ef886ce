"""Parts of a day written as the integer yyyymmdd."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _div(date: str, by: int) -> Column:
    # Integer division: `/` would go through double.
    return F.call_function("div", F.col(date), F.lit(by))


def month_of(date: str = "Date") -> Column:
    return (_div(date, 100) % 100).cast("int")


def year_of(date: str = "Date") -> Column:
    return _div(date, 10000).cast("int")
