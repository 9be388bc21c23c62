"""Cleaning of raw position reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.geo import inside_polygon, project
from fathomline.schema import TIMESTAMP_FORMAT


def parse(raw: DataFrame) -> DataFrame:
    """Timestamps and IMO from text. A timestamp that does not parse is an error; an ETA or IMO that does not is null."""
    return raw.select(
        F.to_timestamp("timestamp_text", TIMESTAMP_FORMAT).alias("ts"),
        *[c for c in raw.columns if c not in ("timestamp_text", "imo_text", "eta_text")],
        F.expr("try_cast(imo_text AS BIGINT)").alias("imo"),
        F.try_to_timestamp("eta_text", F.lit(TIMESTAMP_FORMAT)).alias("eta"),
    )


@dataclass(frozen=True)
class Limits:
    """What a plausible ship stays below (or, for the ship's number, between); numbers of base stations and classes of devices."""

    draught: float = 28.5
    width: float = 75
    length: float = 488
    mmsi: tuple[int, int] = (99999999, 990000000)
    stations: tuple[int, int] = (111000000, 112000000)
    classes: tuple[str, ...] = ("Class A", "Class B")


def plausible(limits: Limits = Limits(), columns: tuple[str, ...] = ("draught", "width", "length", "mmsi", "mobile_type")) -> Column:
    """Rows of plausible ships; rows without width or length are not. Plain comparisons, which reach the scan."""
    draught, width, length, mmsi, kind = map(F.col, columns)
    return (
        ((draught < limits.draught) | draught.isNull())
        & (width < limits.width) & (length < limits.length)
        & (mmsi > limits.mmsi[0]) & (mmsi < limits.mmsi[1])
        & ~((mmsi > limits.stations[0]) & (mmsi < limits.stations[1]))
        & kind.isin(*limits.classes)
    )


def clean(raw: DataFrame, boundary: list[tuple[float, float]] | None = None) -> DataFrame:
    """Parsed, plausible, inside the boundary ring of (lon, lat), with projected ``x`` and ``y``. All narrow: no shuffle."""
    df = parse(raw).where(plausible())
    if boundary:
        df = df.where(inside_polygon(F.col("lon"), F.col("lat"), boundary))
    x, y = project(F.col("lon"), F.col("lat"))
    return df.withColumns({"x": x, "y": y})
