"""The analytic queries over the warehouse, as functions of parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.geo import boxes_meet
from fathomline.operators.cells import fact_cell
from fathomline.operators.heatmap import difference, selected, union_pixels


@dataclass(frozen=True)
class Window:
    """A box in projected metres and a range of date keys; ``until`` is a time key on the last date."""

    xmin: float
    ymin: float
    xmax: float
    ymax: float
    start_id: int
    end_id: int
    until: int = 0

    @property
    def box(self) -> tuple[float, float, float, float]:
        return self.xmin, self.ymin, self.xmax, self.ymax

    def times(self, upper_inclusive: bool = False) -> Column:
        at = lambda k, t: F.to_timestamp(F.lit(f"{k}{t:06d}"), "yyyyMMddHHmmss")
        lo, hi, end = F.col("tmin"), F.col("tmax"), at(self.end_id, self.until)
        return (hi >= at(self.start_id, 0)) & ((lo <= end) if upper_inclusive else (lo < end))


def ships_of_types(ships: DataFrame, types: DataFrame, names: list[str]) -> DataFrame:
    """Ships of some types. Both tables are joined by key; small ones are broadcast by their size."""
    return ships.join(types.where(F.col("ship_type").isin(names)).select("ship_type_id"), "ship_type_id", "left_semi")


def cell_query(facts: DataFrame, ships: DataFrame, types: DataFrame, w: Window, names: list[str]) -> DataFrame:
    """Distinct ships of some types with a cell fact that meets the window [start, end).

    A trajectory is one ship's day, so a fact's times lie in its entry date: the date range prunes partitions, the box
    and times reach the scan, and the ships come by a semi join, so no DISTINCT over wide rows is needed."""
    hits = facts.where(F.col("entry_date_id").between(w.start_id, w.end_id) & boxes_meet(*w.box) & w.times())
    return ships_of_types(ships, types, names).join(hits.select("ship_id"), "ship_id", "left_semi")


def crosses_box(points: Column, w: Window, start: Column, end: Column) -> Column:
    """Whether a linear sequence is in the box at some time of [start, end): each leg is clipped exactly."""
    n = F.greatest(F.size(points) - 1, F.lit(0))
    seconds = lambda c: F.unix_micros(c) / 1e6
    s, e = seconds(start), seconds(end)

    def leg(p: Column, q: Column) -> Column:
        def slab(a: Column, b: Column, lo, hi) -> tuple[Column, Column]:  # noqa: ANN001
            d = b - a
            at = lambda v: (v - a) / F.nullif(d, F.lit(0.0))
            still = F.when(a.between(lo, hi), F.lit(0.0)).otherwise(F.lit(2.0))
            return F.coalesce(F.least(at(F.lit(lo)), at(F.lit(hi))), still), F.coalesce(F.greatest(at(F.lit(lo)), at(F.lit(hi))), F.lit(1.0))

        x0, x1 = slab(p["x"], q["x"], float(w.xmin), float(w.xmax))
        y0, y1 = slab(p["y"], q["y"], float(w.ymin), float(w.ymax))
        tp, tq = seconds(p["t"]), seconds(q["t"])
        from_, to = F.greatest(x0, y0, F.lit(0.0)), F.least(x1, y1, F.lit(1.0))
        return (from_ <= to) & (tp + to * (tq - tp) >= s) & (tp + from_ * (tq - tp) < e)

    return F.exists(F.zip_with(F.slice(points, 1, n), F.slice(points, 2, n), leg), lambda x: x)


def trajectory_query(trajectories: DataFrame, facts: DataFrame, ships: DataFrame, types: DataFrame, w: Window, names: list[str]) -> DataFrame:
    """Distinct ships of some types with a trajectory inside the window: boxes first, then the exact test on what is left."""
    at = lambda k: F.to_timestamp(F.lit(str(k)), "yyyyMMdd")
    near = trajectories.where(F.col("date_id").between(w.start_id, w.end_id) & boxes_meet(*w.box) & w.times())
    hits = near.where(crosses_box(F.col("trajectory"), w, at(w.start_id), at(w.end_id))).select(F.col("date_id").alias("start_date_id"), "trajectory_sub_id")
    ids = facts.where(F.col("start_date_id").between(w.start_id, w.end_id)).join(hits, ["start_date_id", "trajectory_sub_id"], "left_semi").select("ship_id")
    return ships_of_types(ships, types, names).join(ids, "ship_id", "left_semi")


def heatmap_query(heatmaps: DataFrame, types: DataFrame, slug: str, size: int, w: Window, ship_types: list[str], mobile_types: list[str]) -> DataFrame:
    ids = types.where(F.col("ship_type").isin(ship_types) & F.col("mobile_type").isin(mobile_types)).select("ship_type_id")
    return union_pixels(selected(heatmaps, slug, size, w.start_id, w.end_id, tuple(map(int, w.box)), ids), slug)


def heatmap_difference(heatmaps: DataFrame, types: DataFrame, slug: str, size: int, w: Window, a: list[str], b: list[str], mobile_types: list[str]) -> DataFrame:
    one, two = (heatmap_query(heatmaps, types, slug, size, w, s, mobile_types) for s in (a, b))
    return difference(one, two)


def stored_cells(facts: DataFrame, w: Window) -> DataFrame:
    """Stored cell facts in the window [start, end]."""
    return facts.where(F.col("entry_date_id").between(w.start_id, w.end_id) & boxes_meet(*w.box) & w.times(upper_inclusive=True))


def lazy_cells(trajectories: DataFrame, size: int, keys: tuple[str, ...], w: Window) -> DataFrame:
    """The same from trajectories at query time: only those whose boxes come within a cell of the window are cut, then cells outside it go."""
    near = boxes_meet(w.xmin - size, w.ymin - size, w.xmax + size, w.ymax + size) & w.times(upper_inclusive=True)
    return stored_cells(fact_cell(trajectories, size, keys, window=near), w)


def star(facts: DataFrame, dims: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Facts joined with dimensions: role to (dimension, its key, the fact's key). Columns get the role as prefix."""
    for name, (dim, key, fact_key) in dims.items():
        d = dim.select(*[F.col(c).alias(f"{name}_{c}") for c in dim.columns])
        facts = facts.join(d, facts[fact_key] == d[f"{name}_{key}"])
    return facts


__all__ = ["Window", "cell_query", "crosses_box", "heatmap_difference", "heatmap_query", "lazy_cells", "ships_of_types", "star", "stored_cells", "trajectory_query"]
