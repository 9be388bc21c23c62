"""Smart keys (YYYYMMDD, HHMMSS) and other scalar functions on plain columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fathomline.schema import UNKNOWN_INT


def date_key(ts: Column) -> Column:
    """20240131 as int; null gives -1."""
    return F.coalesce(F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts), F.lit(UNKNOWN_INT)).cast("int")


def time_key(ts: Column) -> Column:
    """235959 as int; null gives -1."""
    return F.coalesce(F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts), F.lit(UNKNOWN_INT)).cast("int")


def key_date(key: Column) -> Column:
    """The date of a key; null for -1 and for what is no date."""
    return F.to_date(F.try_to_timestamp(key.cast("string"), F.lit("yyyyMMdd")))


def key_timestamp(date: Column, time: Column) -> Column:
    """The timestamp of a pair of keys."""
    text = F.concat(F.lpad(date.cast("string"), 8, "0"), F.lpad(time.cast("string"), 6, "0"))
    return F.to_timestamp(text, "yyyyMMddHHmmss")


def hour_key(hour: Column) -> Column:
    return (hour * 10000).cast("int")


def hour_of_key(time: Column) -> Column:
    return F.floor(time / 10000).cast("int")


def int_div(a: Column, b: int) -> Column:
    """Integer division that truncates, as ``div``."""
    return ((a - a % b) / b).cast("long")


def real_mod(a: Column, b: float) -> Column:
    """a - floor(a / b) * b."""
    return a - F.floor(a / b) * b


def mid(mmsi: Column) -> Column:
    """The country digits of an MMSI."""
    return F.try_to_number(F.substring(mmsi.cast("string"), 1, 3), F.lit("999")).cast("int")


def size_from_parts(whole: Column, x: Column, y: Column) -> Column:
    """A length (or width): as reported, else the sum of the distances to the antenna, one of them, or -1."""
    unknown = F.lit(-1.0)
    x, y = F.coalesce(x, unknown), F.coalesce(y, unknown)
    parts = F.when((x == unknown) & (y == unknown), unknown).when(x == unknown, y).when(y == unknown, x).otherwise(x + y)
    return F.coalesce(whole, parts)


def lowest_key(entries: dict[str, Column], limit: Column | None = None, limit_name: str = "Unknown") -> Column:
    """The name of the least value; ties go to the first given; the limit competes last. Nulls never win."""
    items = list(entries.items()) + ([(limit_name, limit)] if limit is not None else [])
    rows = [F.struct(F.coalesce(v, F.lit(float("inf"))).alias("v"), F.lit(i).alias("i"), F.lit(k).alias("k")) for i, (k, v) in enumerate(items)]
    return F.array_min(F.array(*rows))["k"]


def resolution_for(area: Column) -> Column:
    """The cell size that suits an area in square metres."""
    return F.when(area >= 2e10, 5000).when(area >= 2e9, 1000).when(area >= 2e8, 200).otherwise(50)


def cleaned(text: Column) -> Column:
    """Null for the placeholders of text columns."""
    return F.when(text.isin("Unknown", "Undefined"), F.lit(None)).otherwise(text)
