"""Dimensions: generated ones, get-or-create with surrogate keys, role views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fathomline.functions.calendar import DAYS, MONTHS, SEASONS, is_holiday, pick
from fathomline.functions.keys import date_key, mid
from fathomline.operators.cells import DIRECTIONS


def date_attributes(dates: DataFrame, column: str = "date") -> DataFrame:
    """The date dimension of distinct dates."""
    d = F.col(column)
    dow = F.dayofweek(d) - 1
    return dates.select(
        date_key(d).alias("date_id"), d.alias("date"), dow.cast("int").alias("day_of_week"), F.dayofmonth(d).alias("day_of_month"), F.dayofyear(d).alias("day_of_year"), F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_of_year"), F.quarter(d).alias("quarter_of_year"), F.year(d).alias("year"), F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("iso_year"),
        pick(DAYS, dow).alias("day_name"), pick(MONTHS, F.month(d) - 1).alias("month_name"), F.when(dow.isin(0, 6), "weekend").otherwise("weekday").alias("weekday"), pick(SEASONS, F.month(d) - 1).alias("season"),
        F.when(is_holiday(d), "holiday").otherwise("non-holiday").alias("holiday"),
    )


def date_range(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.sql("SELECT explode(sequence(to_date(:a), to_date(:b))) AS date", args={"a": first, "b": last})


def distinct_dates(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The dates behind several key columns, unknown ones left out, stacked by one explode instead of a union of scans."""
    keys = df.select(F.explode(F.array(*map(F.col, columns))).alias("k")).where("k <> -1").distinct()
    return keys.select(F.to_date(F.col("k").cast("string"), "yyyyMMdd").alias("date"))


def dim_time(spark: SparkSession) -> DataFrame:
    """86,400 seconds of a day and the unknown row -1."""
    s = F.col("id")
    h, m, sec = F.floor(s / 3600).cast("int"), (F.floor(s / 60) % 60).cast("int"), (s % 60).cast("int")
    known = spark.range(86400).select((h * 10000 + m * 100 + sec).cast("int").alias("time_id"), F.format_string("%02d:%02d:%02d", h, m, sec).alias("time"), h.alias("hour_of_day"), m.alias("minute_of_hour"), sec.alias("second_of_minute"))
    unknown = [F.lit(-1).alias(c) for c in ("hour_of_day", "minute_of_hour", "second_of_minute")]
    return known.unionByName(spark.range(1).select(F.lit(-1).alias("time_id"), F.lit(None).cast("string").alias("time"), *unknown))


def dim_direction(spark: SparkSession) -> DataFrame:
    """All pairs of the five fixed names, numbered from 1."""
    rows = [(i * 5 + j + 1, a, b) for i, a in enumerate(DIRECTIONS) for j, b in enumerate(DIRECTIONS)]
    return spark.createDataFrame(rows, "direction_id int, from string, to string")


def role(dim: DataFrame, prefix: str) -> DataFrame:
    """A role-playing view: all columns renamed."""
    return dim.select(*[F.col(c).alias(prefix + c) for c in dim.columns])


def same(a: DataFrame, b: DataFrame, columns: tuple[str, ...]):
    """Null-safe equality on natural keys."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def get_or_create(existing: DataFrame, batch: DataFrame, natural: tuple[str, ...], key: str) -> DataFrame:
    """The dimension with the batch's new natural keys, numbered on from the largest key in the order of the natural key.

    Only the rows that are new are ranked; numbering them runs in one task, and they are few once the dimension is filled.
    """
    fresh = batch.select(*natural).distinct().alias("f")
    fresh = fresh.join(existing.select(*natural).alias("e"), same(fresh, existing, natural), "left_anti")
    top = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("top"))
    numbered = fresh.select(*natural, F.row_number().over(W.orderBy(*[F.col(c).asc_nulls_first() for c in natural])).alias("rank"))
    numbered = numbered.withColumn("top", top.scalar()).select((F.col("top") + F.col("rank")).cast(existing.schema[key].dataType).alias(key), *natural)
    return existing.select(key, *natural).unionByName(numbered)


def attach_key(facts: DataFrame, dim: DataFrame, natural: tuple[str, ...], key: str) -> DataFrame:
    """Facts with the dimension's key; nulls match nulls."""
    d = role(dim.select(key, *natural), "dim_")
    cond = F.lit(True)
    for c in natural:
        cond = cond & facts[c].eqNullSafe(d[f"dim_{c}"])
    return facts.join(d, cond, "left").select(*[facts[c] for c in facts.columns], F.col(f"dim_{key}").alias(key))


def with_flag_state(ships: DataFrame, mids: DataFrame, unknown: str = "Unknown") -> DataFrame:
    """Ships with ``mid``, ``flag_region`` and ``flag_state`` from a table (mid, flag_region, flag_state) of unique country digits."""
    df = ships.withColumn("mid", mid(F.col("mmsi"))).join(mids, "mid", "left")
    return df.withColumns({c: F.coalesce(c, F.lit(unknown)) for c in ("flag_region", "flag_state")})
