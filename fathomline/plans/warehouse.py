"""Warehouse maintenance: idempotent writes, rollback, audit."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, timedelta
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_days(df: DataFrame, path: str, date_column: str, sort: tuple[str, ...] = (), by: tuple[str, ...] = ()) -> None:
    """Write facts partitioned by month and by ``date_column`` itself, so that filters on it prune folders, replacing only the days
    that are in ``df``; a second load of a day leaves one copy. Callers bound ``df`` to the days they load.

    Rows are dealt by day and ``by``; adaptive execution cuts what is large and joins what is small, so a day is neither one
    task nor many small files. They are sorted so that row-group statistics prune boxes and keys."""
    df = df.withColumn("month_id", F.floor(F.col(date_column) / 100).cast("int"))
    df = df.hint("rebalance", *map(F.col, (date_column, *by)))
    df = df.sortWithinPartitions(date_column, *sort) if sort else df
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month_id", date_column).parquet(path)


def insert_new(existing: DataFrame, rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """The rows to append: one per key, none whose key is there (on conflict do nothing). Of equal keys the least row stays."""
    rest = [c for c in rows.columns if c not in key]
    one = rows.groupBy(*key).agg(F.min(F.struct(*rest)).alias("r")).select(*key, "r.*") if rest else rows.distinct()
    return one.select(*rows.columns).join(existing.select(*key), list(key), "left_anti").select(*rows.columns)


def without_days(df: DataFrame, date_column: str, days: list[int]) -> DataFrame:
    """What is left after a rollback of days of one month."""
    if len({d // 100 % 100 for d in days}) > 1:
        raise ValueError("days of different months cannot be rolled back together")
    return df.where(~F.col(date_column).isin(days)) if days else df


def month_batches(first: int, last: int, most: int = 10) -> Iterator[list[int]]:
    """Days of a range in batches of at most ``most`` that stay within a month."""
    day, end = (date(k // 10000, k // 100 % 100, k % 100) for k in (first, last))
    batch: list[int] = []
    while day <= end:
        key = day.year * 10000 + day.month * 100 + day.day
        if batch and (len(batch) >= most or batch[0] // 100 != key // 100):
            yield batch
            batch = []
        batch.append(key)
        day += timedelta(days=1)
    if batch:
        yield batch


def rollback(spark: SparkSession, tables: dict[str, str], first: int, last: int, most: int = 10) -> list[str]:
    """Remove days from tables written by ``write_days`` (name to path): their partition folders go, nothing is rewritten."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    removed = []
    for batch in month_batches(first, last, most):
        for root in tables.values():
            for day in batch:
                found = jvm.org.apache.hadoop.fs.Path(f"{root}/month_id={day // 100}/*={day}")
                fs = found.getFileSystem(conf)
                for status in fs.globStatus(found):
                    if fs.delete(status.getPath(), True):
                        removed.append(str(status.getPath()))
    return removed


class Audit:
    """Stage timings, row counts and file statistics of one load, appended as one row."""

    def __init__(self, version: str = "unknown", requirements: tuple[str, ...] = ()) -> None:
        self.row: dict[str, Any] = {"version": version, "requirements": list(requirements), "file_size": None, "file_rows": None, "timings": {}, "counts": {}}

    @contextmanager
    def timed(self, stage: str) -> Iterator[None]:
        began = time.perf_counter()
        try:
            yield
        finally:
            self.row["timings"][stage] = time.perf_counter() - began

    def file(self, size: int, rows: int) -> None:
        self.row |= {"file_size": size, "file_rows": rows}

    def observed(self, df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
        """Counts rows as they pass, without another job; hand the observation to ``counted`` after the action."""
        seen = Observation(name)
        return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen

    def counted(self, name: str, seen: Observation) -> None:
        self.row["counts"][name] = seen.get["rows"]

    def frame(self, spark: SparkSession) -> DataFrame:
        r = self.row
        values = (r["version"], r["requirements"], r["file_size"], r["file_rows"], json.dumps(r["timings"], sort_keys=True), json.dumps(r["counts"], sort_keys=True))
        return spark.createDataFrame([values], "version string, requirements array<string>, file_size long, file_rows long, timings string, counts string")

    def append(self, spark: SparkSession, path: str) -> None:
        self.frame(spark).write.mode("append").parquet(path)


def retried(action: Callable[[], Any], times: int = 5, wait: float = 0.0, errors: tuple[type[Exception], ...] = (Exception,)) -> Any:
    """The action's result, tried again on errors; the last error if none of the tries works."""
    for i in range(times):
        try:
            return action()
        except errors:
            if i == times - 1:
                raise
            time.sleep(wait)
    return None
