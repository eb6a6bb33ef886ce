"""Country codes, names and seasons."""

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from meteorill.schemas import COUNTRIES, MONTH_NAMES, SEASON_BY_MONTH, SEASON_NAMES


def fips_code(station: str = "StationId") -> Column:
    """A station belongs to the country named by its first two characters."""
    return F.substring(F.col(station), 1, 2)


def is_station_of(codes: Iterable[str], station: str = "ID") -> Column:
    """True for an id that starts with one of the codes and goes on after it."""
    return fips_code(station).isin(list(codes)) & (F.length(F.col(station)) > 2)


def lookup(key: Column, values: Mapping) -> Column:
    """Value of `key` in a small constant mapping, null when it is not in there."""
    entries = [F.lit(item) for pair in values.items() for item in pair]
    return F.create_map(*entries)[key]


def country_name(code: str = "FIPS_code") -> Column:
    return lookup(F.col(code), COUNTRIES)


def month_name(month: str = "Month") -> Column:
    return lookup(F.col(month), MONTH_NAMES)


def season_name(season_number: str = "Season") -> Column:
    return lookup(F.col(season_number), SEASON_NAMES)


def season(code: str = "FIPS_code", month: str = "Month") -> Column:
    """Season 1..4 of a month by the calendar of the country, null for an unknown code or month."""
    chain = None
    for fips, seasons in SEASON_BY_MONTH.items():
        calendar = F.get(F.array(*[F.lit(s) for s in seasons]), F.col(month) - 1)
        condition = F.col(code) == fips
        chain = F.when(condition, calendar) if chain is None else chain.when(condition, calendar)
    return chain
