"""Calendar attributes: names, seasons, holidays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names by number (Sunday is 0), seasons by month, fixed holidays as (month, day).
DAYS = ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday")
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
SEASONS = ("winter", "winter", "spring", "spring", "spring", "summer", "summer", "summer", "autumn", "autumn", "autumn", "winter")
FIXED_HOLIDAYS = ((1, 1), (5, 15), (5, 16), (6, 5), (12, 24), (12, 25), (12, 26), (12, 31))
EASTER_OFFSETS = (0, 1, -2, -3, -7, 40)


def pick(names: tuple[str, ...], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), (at + 1).cast("int"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it stands there."""
    return F.get(F.transform(F.array(value), body), 0)


def easter_march_day(year: Column) -> Column:
    """Easter Sunday as a day of March (32 is the first of April); valid for 1900 to 2099."""
    d = let(F.lit(225) - (year % 19) * 11, lambda d: d - F.greatest(F.lit(0), F.floor((d - 21) / 30)) * 30)  # below 51
    d = let(d, lambda d: F.when(d > 48, d - 1).otherwise(d))
    return let(d, lambda d: d + 7 - (year + F.floor(year / 4) + d + 1) % 7).cast("int")


def easter_holidays(year: Column) -> Column:
    """Keys month * 100 + day. Months are taken to have 31 days when an offset leaves one, which puts the last
    offset on the 39th day after an Easter in April and matches no date for an Easter on the 22nd of March."""

    def shifted(q: Column, offset: int) -> Column:
        month, x = F.when(q < 32, 3).otherwise(4), F.when(q < 32, q).otherwise(q - 31) + offset
        over = F.when(x > 31, F.floor((x - 1) / 31)).when(x < 1, F.lit(-1)).otherwise(F.lit(0))
        return ((month + over) * 100 + x - over * 31).cast("int")

    return let(easter_march_day(year), lambda q: F.array(*[shifted(q, o) for o in EASTER_OFFSETS]))


def is_holiday(date: Column) -> Column:
    md = F.month(date) * 100 + F.dayofmonth(date)
    return md.isin([m * 100 + d for m, d in FIXED_HOLIDAYS]) | F.array_contains(easter_holidays(F.year(date)), md)
