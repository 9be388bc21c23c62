"""Trajectories: outliers, segments, attributes, arrays.

One shuffle deals points by ship and day; the outlier pass, the window functions and the aggregation into
segments all keep that partitioning, so nothing is dealt again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fathomline.functions.keys import cleaned, date_key, size_from_parts, time_key
from fathomline.functions.temporal import compress_steps
from fathomline.schema import GAP_SECONDS, KNOTS, MAX_KNOTS, MIN_POINTS, SEQUENCE, SIMPLIFY_METRES, SOG_TOLERANCE, STOP_KNOTS, STOP_SECONDS


def is_outlier(x: float, y: float, px: float, py: float, seconds: float, sog: float, limit: float = MAX_KNOTS) -> tuple[bool, float]:
    """(verdict, repaired SOG) of a point against the last point kept. Comparisons with NaN are false."""
    if seconds == 0:
        return True, sog
    speed = math.hypot(x - px, y - py) / seconds * KNOTS
    if math.isnan(sog) or abs(sog - speed) >= SOG_TOLERANCE:
        sog = speed
    return sog > limit, sog


def keep_points(t: np.ndarray, x: np.ndarray, y: np.ndarray, sog: np.ndarray, limit: float = MAX_KNOTS) -> tuple[np.ndarray, np.ndarray]:
    """(kept, repaired SOG) of one ship's points in time order; the first is kept as it is. ``t`` in seconds."""
    kept, out = np.zeros(len(t), bool), sog.astype(float).copy()
    if len(t):
        kept[0], last = True, 0
        for i in range(1, len(t)):
            wrong, out[i] = is_outlier(x[i], y[i], x[last], y[last], t[i] - t[last], out[i], limit)
            if not wrong:
                kept[i], last = True, i
    return kept, out


def drop_outliers(points: DataFrame, keys: tuple[str, ...] = ("mmsi", "day"), ts: str = "ts", order: tuple[str, ...] = (), limit: float = MAX_KNOTS) -> DataFrame:
    """The fold against the last kept point: each verdict depends on those before, so it runs in Python per group.

    A group is one ship's day, which bounds its size."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([ts, *order], kind="stable")
        seconds = pdf[ts].astype("int64").to_numpy() / {"ns": 1e9, "us": 1e6, "ms": 1e3, "s": 1}[np.datetime_data(pdf[ts].dtype)[0]]
        kept, sog = keep_points(seconds, pdf["x"].to_numpy(float), pdf["y"].to_numpy(float), pdf["sog"].to_numpy(float), limit)
        return pdf.assign(sog=sog)[kept]

    return points.groupBy(*keys).applyInPandas(fold, points.schema)


def segments(
    points: DataFrame, keys: tuple[str, ...] = ("mmsi", "day"), ts: str = "ts", sog: str = "sog", order: tuple[str, ...] = (),
    gap: float = GAP_SECONDS, stop_seconds: float = STOP_SECONDS, stop_knots: float = STOP_KNOTS, min_points: int = MIN_POINTS,
) -> DataFrame:
    """Adds ``segment`` (numbered from 1 within the keys) and ``infer_stopped``; segments of too few points go.

    Slow points (below ``stop_knots``, null and NaN included) in a row that lasts ``stop_seconds`` are a stop. A segment
    begins at the first point, where stopping begins or ends, and after a gap."""
    by = W.partitionBy(*keys).orderBy(ts, *order)
    run = W.partitionBy(*keys, "slow_run")
    seconds = F.unix_micros(F.col(ts).cast("timestamp")) / 1e6
    fast = F.coalesce((F.col(sog) >= stop_knots) & ~F.isnan(sog), F.lit(False))
    df = points.withColumns({"slow": ~fast, "seconds": seconds})
    df = df.withColumn("changed", F.coalesce((F.col("slow") != F.lag("slow").over(by)).cast("int"), F.lit(0)))
    df = df.withColumn("slow_run", F.sum("changed").over(by.rowsBetween(W.unboundedPreceding, 0)))
    df = df.withColumn("infer_stopped", F.col("slow") & (F.max("seconds").over(run) - F.min("seconds").over(run) >= stop_seconds))
    new = F.lag("seconds").over(by).isNull() | (F.col("infer_stopped") != F.lag("infer_stopped").over(by)) | (F.col("seconds") - F.lag("seconds").over(by) >= gap)
    df = df.withColumn("begins", new.cast("int")).withColumn("segment", F.sum("begins").over(by.rowsBetween(W.unboundedPreceding, 0)))
    df = df.withColumn("in_segment", F.count("*").over(W.partitionBy(*keys, "segment")))
    return df.where(F.col("in_segment") >= min_points).drop("slow", "seconds", "changed", "slow_run", "begins", "in_segment")


def most_frequent(c: Column) -> Column:
    """The mode without nulls; of several, the least."""
    return F.mode(c, True)


#: Attributes of a ship-day, each the mode of its column with placeholders read as null.
SHIP_TEXT = ("mobile_type", "position_fixing_device", "ship_type", "name", "callsign", "data_source_type")
SHIP_NUMBERS = ("imo", "a", "b", "c", "d", "length", "width")


def trajectories(points: DataFrame, keys: tuple[str, ...] = ("mmsi", "day")) -> DataFrame:
    """One row per segment of cleaned points that ``segments`` has marked: keys, times, modes, arrays.

    The ship's attributes are modes over its day, as windows on the partitioning at hand, so points pass once."""
    day = W.partitionBy(*keys)
    points = points.withColumns({f"ship_{c}": most_frequent(cleaned(F.col(c)) if c in SHIP_TEXT else F.col(c)).over(day) for c in (*SHIP_TEXT, *SHIP_NUMBERS)})
    joint = F.mode(F.struct("eta", "nav_status", "destination"), True)
    step = lambda c: F.array_sort(F.collect_list(F.struct(F.col("ts").alias("t"), F.col(c).cast("double").alias("v"))))
    rows = points.groupBy(*keys, "segment", "infer_stopped").agg(
        F.min("ts").alias("start"), F.max("ts").alias("end"), joint.alias("joint"),
        F.array_sort(F.collect_list(F.struct(F.col("ts").alias("t"), "x", "y"))).alias("trajectory"),
        *[step(c).alias(c) for c in ("rot", "heading", "draught")], *[F.first(f"ship_{c}").alias(c) for c in (*SHIP_TEXT, *SHIP_NUMBERS)],
    )
    rows = rows.withColumns({"length": size_from_parts(F.col("length"), F.col("a"), F.col("b")), "width": size_from_parts(F.col("width"), F.col("c"), F.col("d"))})
    return rows.select(
        *keys, "segment", "infer_stopped",
        date_key(F.col("start")).alias("start_date_id"), time_key(F.col("start")).alias("start_time_id"), date_key(F.col("end")).alias("end_date_id"), time_key(F.col("end")).alias("end_time_id"),
        date_key(F.col("joint.eta")).alias("eta_date_id"), time_key(F.col("joint.eta")).alias("eta_time_id"),
        F.coalesce("joint.nav_status", F.lit("Unknown")).alias("nav_status"), F.coalesce("joint.destination", F.lit("UNKNOWN DESTINATION")).alias("destination"),
        (F.unix_micros("end") - F.unix_micros("start")).alias("duration_us"), "trajectory",
        *[compress_steps(F.col(c)).alias(c) for c in ("rot", "heading", "draught")],
        *[F.coalesce(c, F.lit("Unknown")).alias(c) for c in SHIP_TEXT], F.coalesce("imo", F.lit(-1)).alias("imo"),
        *[F.coalesce(c, F.lit(-1.0)).alias(c) for c in SHIP_NUMBERS if c != "imo"],
    )


def build(clean_points: DataFrame, outliers: bool = True) -> DataFrame:
    """Cleaned points to trajectories, one ship and day at a time."""
    df = clean_points.withColumn("day", date_key(F.col("ts")))
    if outliers:
        df = drop_outliers(df)
    return trajectories(segments(df))


def _simplified(t: np.ndarray, x: np.ndarray, y: np.ndarray, metres: float) -> np.ndarray:
    """Douglas-Peucker on synchronised distance: how far a point is from where the chord would be at its time."""
    keep = np.zeros(len(t), bool)
    keep[[0, -1]] = True
    stack = [(0, len(t) - 1)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        u = (t[a + 1 : b] - t[a]) / (t[b] - t[a] or 1)
        d = np.hypot(x[a + 1 : b] - x[a] - u * (x[b] - x[a]), y[a + 1 : b] - y[a] - u * (y[b] - y[a]))
        far = int(d.argmax())
        if d[far] > metres:
            keep[a + 1 + far] = True
            stack += [(a, a + 1 + far), (a + 1 + far, b)]
    return keep


def simplify(df: DataFrame, column: str = "trajectory", metres: float = SIMPLIFY_METRES) -> DataFrame:
    """Simplify an array of (t, x, y); arrays of fewer than three points stay."""

    @F.pandas_udf(SEQUENCE)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for arrays in batches:
            out = []
            for points in arrays:
                if points is None or len(points) < 3:
                    out.append(points)
                    continue
                t = np.array([pd.Timestamp(p["t"]).value for p in points]) / 1e9
                keep = _simplified(t, np.array([p["x"] for p in points]), np.array([p["y"] for p in points]), metres)
                out.append([p for p, k in zip(points, keep, strict=True) if k])
            yield pd.Series(out)

    return df.withColumn(column, run(column))
