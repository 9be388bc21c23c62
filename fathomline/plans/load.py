"""The daily load: reports to trajectories, dimensions, cell facts and heatmaps in a warehouse folder."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions.geo import path_length
from fathomline.functions.keys import date_key
from fathomline.operators import dims, heatmap
from fathomline.operators.cells import fact_cell, used_cells
from fathomline.operators.clean import clean
from fathomline.operators.partition import assign_partition
from fathomline.operators.trajectory import build, simplify
from fathomline.plans.warehouse import Audit, write_days
from fathomline.schema import CELL_SIZES, TIMESTAMP_FORMAT, UNKNOWN_TEXT

SHIP = ("imo", "mmsi", "name", "callsign", "a", "b", "c", "d", "width", "length", "data_source_type", "ship_type_id")
SHIP_TYPE = ("mobile_type", "ship_type")


class Warehouse:
    """Tables below one folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def dimension(self, name: str, key: str, batch: DataFrame, natural: tuple[str, ...]) -> DataFrame:
        """Get or create the batch's rows. New rows are appended, so readers of the table keep their files."""
        schema = ", ".join([f"{key} long", *(f"{c} {batch.schema[c].dataType.simpleString()}" for c in natural)])
        old = self.read(name) if self.exists(name) else self.spark.createDataFrame([], schema)
        full = dims.get_or_create(old, batch, natural, key)
        full.join(old.select(key), key, "left_anti").write.mode("append").parquet(self.path(name))
        return self.read(name)


def initialise(w: Warehouse, first: str, last: str) -> None:
    """Static dimensions."""
    for name, df in {
        "dim_date": dims.date_attributes(dims.date_range(w.spark, first, last)), "dim_time": dims.dim_time(w.spark),
        "dim_direction": dims.dim_direction(w.spark), "dim_heatmap_type": heatmap.dim_heatmap_type(w.spark),
    }.items():
        df.write.mode("overwrite").parquet(w.path(name))


def main_day(points: DataFrame) -> int | None:
    """The date of most points; of several, the first; none without points."""
    top = points.groupBy(date_key(F.col("ts")).alias("day")).count().orderBy(F.desc("count"), "day").first()
    return None if top is None else top["day"]


def build_day(raw: DataFrame, boundary=None, day: int | None = None) -> tuple[DataFrame, int | None]:  # noqa: ANN001
    """(trajectories of one day's raw reports, its date key): ``day`` or that of most reports; none without plausible reports."""
    points = clean(raw, boundary)
    if day is None:
        day = main_day(points)
    built = build(points.where(date_key(F.col("ts")) == F.lit(day))).withColumn("trajectory_sub_id", F.xxhash64("mmsi", "segment", "start_time_id").bitwiseAND(F.lit((1 << 63) - 1)))
    return simplify(built).withColumn("metres", path_length(F.col("trajectory"))), day


def load_day(
    w: Warehouse, raw: DataFrame, partitions: DataFrame | None = None, boundary=None, sizes: tuple[int, ...] = CELL_SIZES, audit: Audit | None = None,  # noqa: ANN001
    day: int | None = None, mids: DataFrame | None = None,
) -> Audit:
    """Load the reports of one day, ``day`` or that of most reports; loading it again replaces it. Reports of other days
    are left out, so nothing but this day is ever replaced. Without plausible reports nothing is written but the audit row."""
    audit = audit or Audit()
    with audit.timed("trajectories"):
        built, day = build_day(raw, boundary, day)
        if day is not None:
            staging = w.path(f"staging_trajectories/{day}")
            built.write.mode("overwrite").parquet(staging)
            built = w.spark.read.parquet(staging)
    if day is None:
        audit.append(w.spark, w.path("audit_log"))
        return audit
    return load_trajectories(w, built, day, partitions, sizes, audit, mids)


def load_trajectories(
    w: Warehouse, built: DataFrame, day: int, partitions: DataFrame | None = None, sizes: tuple[int, ...] = CELL_SIZES, audit: Audit | None = None, mids: DataFrame | None = None,
) -> Audit:
    """Load a day's trajectories as ``build_day`` makes them, read from a table.

    ``mids``: country digits (mid, flag_region, flag_state) for the ship dimension."""
    audit = audit or Audit()
    if not built.limit(1).count():
        audit.row["counts"]["fact_trajectory"] = 0
        audit.append(w.spark, w.path("audit_log"))
        return audit
    with audit.timed("dimensions"):
        types = w.dimension("dim_ship_type", "ship_type_id", built, SHIP_TYPE)
        ships_in = dims.attach_key(built, types, SHIP_TYPE, "ship_type_id")
        ship = SHIP
        if mids is not None:
            ships_in, ship = dims.with_flag_state(ships_in, mids), (*SHIP, "mid", "flag_region", "flag_state")
        ships = w.dimension("dim_ship", "ship_id", ships_in, ship)
        status = w.dimension("dim_nav_status", "nav_status_id", built, ("nav_status",))
        keyed = dims.attach_key(dims.attach_key(ships_in, ships, ship, "ship_id"), status, ("nav_status",), "nav_status_id")
        keyed = keyed.withColumn("nav_status", F.coalesce("nav_status", F.lit(UNKNOWN_TEXT)))
    with audit.timed("facts"):
        xs, ys = F.transform("trajectory", lambda p: p["x"]), F.transform("trajectory", lambda p: p["y"])
        ts = F.transform("trajectory", lambda p: p["t"])
        boxed = keyed.withColumns({"xmin": F.array_min(xs), "xmax": F.array_max(xs), "ymin": F.array_min(ys), "ymax": F.array_max(ys), "tmin": F.array_min(ts), "tmax": F.array_max(ts)})
        facts, seen = audit.observed(boxed.select("ship_id", "start_date_id", "start_time_id", "end_date_id", "end_time_id", "eta_date_id", "eta_time_id", "nav_status_id", "infer_stopped", "trajectory_sub_id", "duration_us", "metres"), "fact_trajectory")
        write_days(facts, w.path("fact_trajectory"), "start_date_id", ("ship_id",))
        audit.counted("fact_trajectory", seen)
        write_days(boxed.select(F.col("start_date_id").alias("date_id"), "trajectory_sub_id", "destination", "trajectory", "heading", "rot", "draught", "xmin", "ymin", "xmax", "ymax", "tmin", "tmax"), w.path("dim_trajectory"), "date_id", ("xmin", "ymin"))
    for size in sorted(sizes, reverse=True):
        with audit.timed(f"cells_{size}"):
            cells = fact_cell(keyed, size, ("start_date_id", "trajectory_sub_id"), ("ship_id", "ship_type_id", "nav_status_id", "infer_stopped"))
            cells = assign_partition(cells, partitions) if partitions is not None else cells.withColumn("partition_id", F.lit(0))
            write_days(cells.drop("start_date_id", "crossing"), w.path(f"fact_cell_{size}m"), "entry_date_id", ("partition_id", "cell_x", "cell_y"), ("partition_id",))
            stored = w.read(f"fact_cell_{size}m").where(F.col("entry_date_id") == day)
            add_cells(w, stored, size)
        with audit.timed(f"heatmaps_{size}"):
            write_days(heatmap.preaggregate(stored, size), w.path(f"fact_cell_heatmap_{size}m"), "date_id", ("partition_id", "cell_x", "cell_y"), ("partition_id",))
    audit.append(w.spark, w.path("audit_log"))
    return audit


def add_cells(w: Warehouse, stored: DataFrame, size: int) -> None:
    """Append the cells of a day that the dimension does not have yet; the work grows with the day and its cells, not with the history's facts."""
    name, fresh = f"dim_cell_{size}m", used_cells(stored, size)
    if w.exists(name):
        fresh = fresh.join(w.read(name).select("cell_x", "cell_y"), ["cell_x", "cell_y"], "left_anti")
    fresh.write.mode("append").parquet(w.path(name))


def take_reports(w: Warehouse, raw: DataFrame, batch: int, **options: Any) -> list[int]:
    """A micro-batch of raw reports: kept by day and batch, then each of its days is loaded anew from all reports kept for it.

    A batch that runs twice replaces its own reports, and a second file of a day adds to the first. Reports without a date
    are an error, as in ``clean``."""
    path, at = w.path("reports"), F.to_timestamp("timestamp_text", TIMESTAMP_FORMAT)
    kept = raw.withColumns({"day": date_key(at), "batch": F.lit(batch)})
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(path)
    days = sorted(r["day"] for r in w.read("reports").where(F.col("batch") == batch).select("day").distinct().collect())
    for day in days:
        load_day(w, w.read("reports").where(F.col("day") == day).drop("day", "batch"), day=day, **options)
    return days
