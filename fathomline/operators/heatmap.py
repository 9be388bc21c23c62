"""Heatmaps as rows of pixels: pre-aggregation, union, average, difference.

A pixel is a cell; a raster of a 5 km tile is the rows of one group. Measures are additive (or a maximum), so
heatmaps of any period come from the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions.keys import hour_of_key, key_timestamp
from fathomline.operators.cells import parent_of
from fathomline.schema import TEMPORAL_RESOLUTION, TILE

# Fixed values: (slug, name, description, union, pixel type) of the heatmap types, numbered from 1.
TYPES = (
    ("count", "Count", "Count of trajectories crossing the cell", "SUM", "32BSI"),
    ("delta_cog", "Delta Course Over Ground", "The average change in course over ground of trajectories crossing the cell", "SUM", "32BF"),
    ("delta_heading", "Delta Heading", "The average change in heading of trajectories crossing the cell", "SUM", "32BF"),
    ("max_draught", "Maximum Draught", "The maximum draught of trajectories crossing the cell", "MAX", "32BF"),
    ("time", "Time", "The sum of time spent in the cell by trajectories crossing the cell (as seconds)", "SUM", "32BSI"),
)
UNION = {t[0]: t[3] for t in TYPES}
ID = {t[0]: i for i, t in enumerate(TYPES, 1)}
TWO_BANDS = ("delta_cog", "delta_heading")


def dim_heatmap_type(spark) -> DataFrame:
    return spark.createDataFrame([(i, *t) for i, t in enumerate(TYPES, 1)], "heatmap_type_id int, slug string, name string, description string, union_type string, pixel_type string")


def preaggregate(facts: DataFrame, size: int) -> DataFrame:
    """All heatmap types of cell facts in one aggregation: a row per pixel, date, hour, ship type, stopped flag and type.

    Facts need cell_x, cell_y, entry_date_id, entry_time_id, ship_type_id, infer_stopped, partition_id, tmin, tmax and the
    measures. ``band1``, ``band2``: value and, for averages, count; a value of 0 is no data there."""
    keys = ("partition_id", "cell_x", "cell_y", "infer_stopped", "entry_date_id", "hour", "ship_type_id")
    df = facts.withColumn("hour", hour_of_key(F.col("entry_time_id"))).groupBy(*keys).agg(
        F.count("*").cast("double").alias("n"), F.sum("delta_cog").alias("cog"), F.sum("delta_heading").alias("heading"), F.max("draught").alias("draught"),
        F.sum(F.unix_seconds("tmax") - F.unix_seconds("tmin")).cast("double").alias("seconds"),
    )
    bands = {"count": ("n", None), "delta_cog": ("cog", "n"), "delta_heading": ("heading", "n"), "max_draught": ("draught", None), "time": ("seconds", None)}
    as_float = lambda slug, c: F.col(c).cast("float").cast("double") if slug in ("delta_cog", "delta_heading", "max_draught") else F.col(c)
    none = F.lit(None).cast("double")
    items = [
        F.struct(F.lit(ID[s]).alias("heatmap_type_id"), (F.nullif(as_float(s, a), F.lit(0.0)) if s in TWO_BANDS else as_float(s, a)).alias("band1"), (F.col(b) if b else none).alias("band2"))
        for s, (a, b) in bands.items()
    ]
    df = df.select(*keys, F.explode(F.array(*items)).alias("h"))
    return df.select(
        F.col("cell_x").alias("pixel_x"), F.col("cell_y").alias("pixel_y"), parent_of(F.col("cell_x"), size, TILE).alias("cell_x"), parent_of(F.col("cell_y"), size, TILE).alias("cell_y"),
        F.col("entry_date_id").alias("date_id"), (F.col("hour") * 10000).alias("time_id"), "ship_type_id", "h.*",
        F.lit(size).alias("spatial_resolution"), F.lit(TEMPORAL_RESOLUTION).alias("temporal_resolution_sec"), "infer_stopped", "partition_id",
    ).where("band1 is not null or band2 is not null")


def selected(heatmaps: DataFrame, slug: str, size: int, start_id: int, end_id: int, box: tuple[int, int, int, int], ship_type_ids: DataFrame | None = None) -> DataFrame:
    """The rows of a query: whole tiles whose ids lie in the box (a partial last tile is left out), whole days."""
    xmin, ymin, xmax, ymax = (v // TILE for v in box)
    at = key_timestamp(F.col("date_id"), F.col("time_id"))
    df = heatmaps.where(
        (F.col("spatial_resolution") == size) & (F.col("heatmap_type_id") == ID[slug]) & F.col("date_id").between(start_id, end_id)
        & (F.col("cell_x") >= xmin) & (F.col("cell_x") < xmax) & (F.col("cell_y") >= ymin) & (F.col("cell_y") < ymax)
        & (at >= key_timestamp(F.lit(start_id), F.lit(0))) & (at <= key_timestamp(F.lit(end_id), F.lit(235959)))
    )
    return df if ship_type_ids is None else df.join(ship_type_ids, "ship_type_id", "left_semi")


def union_pixels(rows: DataFrame, slug: str) -> DataFrame:
    """Union by the type's rule within each partition, averages divided out: (partition_id, pixel_x, pixel_y, value)."""
    f = F.sum if UNION[slug] == "SUM" else F.max
    df = rows.groupBy("partition_id", "pixel_x", "pixel_y").agg(f("band1").alias("band1"), f("band2").alias("band2"))
    value = F.col("band1") / F.nullif(F.col("band2"), F.lit(0.0)) if slug in TWO_BANDS else F.col("band1")
    return df.select("partition_id", "pixel_x", "pixel_y", value.alias("value")).where("value is not null")


def difference(a: DataFrame, b: DataFrame, bounded: bool = True) -> DataFrame:
    """Pixels of A minus B, in partitions that both have, as integers truncated toward 0.

    Where only B has a pixel its value is taken as it is, where only A has one it is negated. ``bounded`` keeps the pixels in
    the intersection of both extents of a partition."""
    both = a.select("partition_id").distinct().join(b.select("partition_id").distinct(), "partition_id", "left_semi")
    x = a.join(both, "partition_id", "left_semi").withColumnRenamed("value", "va")
    y = b.join(both, "partition_id", "left_semi").withColumnRenamed("value", "vb")
    out = x.join(y, ["partition_id", "pixel_x", "pixel_y"], "full")
    if bounded:
        box = lambda d, s: d.groupBy("partition_id").agg(*[f(f"pixel_{c}").alias(f"{s}{c}{n}") for c in "xy" for n, f in (("0", F.min), ("1", F.max))])
        out = out.join(box(x, "a"), "partition_id").join(box(y, "b"), "partition_id")
        inside = [F.col(f"pixel_{c}").between(F.greatest(f"a{c}0", f"b{c}0"), F.least(f"a{c}1", f"b{c}1")) for c in "xy"]
        out = out.where(inside[0] & inside[1])
    value = F.when(F.col("va").isNull(), F.col("vb")).when(F.col("vb").isNull(), -F.col("va")).otherwise(F.col("va") - F.col("vb"))
    return out.select("partition_id", "pixel_x", "pixel_y", value.cast("int").alias("value"))
