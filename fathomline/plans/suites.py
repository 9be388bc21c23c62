"""The benchmark suites over a warehouse: cells, heatmaps, lazy cells."""

from __future__ import annotations

import random
from datetime import date, timedelta
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.operators import heatmap
from fathomline.plans import queries
from fathomline.plans.benchmark import Benchmark, benchmark
from fathomline.plans.load import Warehouse
from fathomline.plans.queries import Window
from fathomline.schema import DOMAIN, TILE

# Boxes in projected metres and periods as date keys.
CELL_AREAS = {"single_partition": (3963950, 3124950, 3965950, 3128250), "small_area": (4012045, 3243300, 4018200, 3250900), "medium_area": (4003600, 3381500, 4093500, 3443000), "large_area": (3551600, 2980550, 4427050, 3592300)}
CELL_PERIODS = {"1_day": (20210110, 20210111), "30_day": (20210126, 20210225), "90_day": (20210101, 20210401)}
AREAS_OF_SIZE = {50: ("single_partition", "small_area"), 200: ("single_partition", "medium_area"), 1000: ("single_partition", "medium_area", "large_area"), 5000: ("medium_area", "large_area")}
HEATMAP_AREAS = {"aarhus": (4012045, 3243300, 4018200, 3250900), "storebaelt": (4032800, 3145500, 4078100, 3213300), "complete": (3480000, 2930000, 4495000, 3645000)}
HEATMAP_PERIODS = {"1_day": (20210228, 20210228), "1_month": (20210601, 20210630), "1_year": (20210101, 20211231)}
RESOLUTIONS = {5000: "very_low_resolution", 1000: "low_resolution", 200: "medium_resolution", 50: "high_resolution"}
LAZY_AREAS = {"south_west_lesoe": (4069967.878424203, 3342436.4153025905, 4084991.6610816685, 3353365.3303206693), "near_heligoland": (3804735.697192613, 3046556.109433946, 3886739.220561706, 3134232.6485297997)}
LAZY_PERIODS = {"1_day": (20210504, 20210504), "1_week": (20210621, 20210628), "1_month": (20211001, 20211031)}
CELL_TYPES, HEATMAP_TYPES, OTHER_TYPES, MOBILE_TYPES = ["Cargo"], ["Cargo"], ["Pleasure"], ["Class A", "Class B"]


def trajectories_of(w: Warehouse) -> DataFrame:
    """Trajectories with the fact's columns that cells carry."""
    facts = w.read("fact_trajectory").select("start_date_id", "trajectory_sub_id", "ship_id", "nav_status_id", "infer_stopped")
    return w.read("dim_trajectory").withColumnRenamed("date_id", "start_date_id").join(facts, ["start_date_id", "trajectory_sub_id"])


def random_window(rng: random.Random, first: date = date(2021, 1, 1), last: date = date(2021, 12, 31)) -> tuple[Window, int]:
    """A window of whole tiles in the domain, with a period in [first, last], and the cell size that suits its area."""
    x0, y0 = (rng.randrange(DOMAIN[i] // TILE, DOMAIN[i + 2] // TILE) for i in (0, 1))
    x1, y1 = rng.randint(x0 + 1, DOMAIN[2] // TILE), rng.randint(y0 + 1, DOMAIN[3] // TILE)
    days = sorted(first + timedelta(days=rng.randint(0, (last - first).days)) for _ in range(2))
    start, end = (int(f"{d:%Y%m%d}") for d in days)
    area = (x1 - x0) * (y1 - y0) * TILE**2
    size = next((s for s, least in ((5000, 2e10), (1000, 2e9), (200, 2e8)) if area >= least), 50)
    return Window(x0 * TILE, y0 * TILE, x1 * TILE, y1 * TILE, start, end), size


def warm_up(w: Warehouse, sizes: tuple[int, ...]):  # noqa: ANN201
    """A query of random parameters: place, period, two to ten ship types, heatmap type."""

    def run(rng: random.Random) -> DataFrame:
        window, size = random_window(rng)
        size = size if size in sizes else max(sizes)
        types = w.read("dim_ship_type")
        names = sorted(r[0] for r in types.select("ship_type").where("ship_type is not null").distinct().collect())  # a dimension of a few dozen types
        chosen = rng.sample(names, min(len(names), rng.randint(2, 10)))
        return queries.heatmap_query(w.read(f"fact_cell_heatmap_{size}m"), types, rng.choice(sorted(heatmap.ID)), size, window, chosen, MOBILE_TYPES)

    return run


@benchmark("CELL")
class CellSuite(Benchmark):
    """Ships of some types in a window, from cells of each size and from trajectories."""

    @classmethod
    def over(cls, w: Warehouse, sizes: tuple[int, ...] = tuple(AREAS_OF_SIZE)) -> CellSuite:
        found: dict[str, dict[str, Any]] = {}
        for period, (start, end) in CELL_PERIODS.items():
            for size in sizes:
                for area in AREAS_OF_SIZE[size]:
                    found[f"cell_{size}m_{period}_{area}"] = {"size": size, "window": Window(*CELL_AREAS[area], start, end)}
            for area, box in CELL_AREAS.items():
                found[f"trajectory_{period}_{area}"] = {"size": None, "window": Window(*box, start, end)}

        def query(size: int | None, window: Window) -> DataFrame:
            ships, types = w.read("dim_ship"), w.read("dim_ship_type")
            if size is None:
                return queries.trajectory_query(w.read("dim_trajectory"), w.read("fact_trajectory"), ships, types, window, CELL_TYPES)
            return queries.cell_query(w.read(f"fact_cell_{size}m"), ships, types, window, CELL_TYPES)

        return cls(found, query, [warm_up(w, sizes)])


@benchmark("HEATMAP")
class HeatmapSuite(Benchmark):
    """Heatmaps of counts, and their differences between ship types."""

    @classmethod
    def over(cls, w: Warehouse, sizes: tuple[int, ...] = tuple(RESOLUTIONS)) -> HeatmapSuite:
        found = {
            f"{kind}_{period}_{RESOLUTIONS[size]}_{area}": {"kind": kind, "size": size, "window": Window(*box, *days)}
            for kind in ("heatmap", "difference") for period, days in HEATMAP_PERIODS.items() for size in sizes for area, box in HEATMAP_AREAS.items()
        }

        def query(kind: str, size: int, window: Window) -> DataFrame:
            pixels, types = w.read(f"fact_cell_heatmap_{size}m"), w.read("dim_ship_type")
            if kind == "heatmap":
                return queries.heatmap_query(pixels, types, "count", size, window, HEATMAP_TYPES, MOBILE_TYPES)
            return queries.heatmap_difference(pixels, types, "count", size, window, HEATMAP_TYPES, OTHER_TYPES, MOBILE_TYPES)

        return cls(found, query, [warm_up(w, sizes)])


@benchmark("LAZY")
class LazySuite(Benchmark):
    """Cells of 50 metres, cut at query time or stored."""

    @classmethod
    def over(cls, w: Warehouse, size: int = 50) -> LazySuite:
        found = {
            f"{how}_{period}_{area}": {"how": how, "window": Window(*box, *days, until=235959)}
            for how in ("lazy", "stored") for period, days in LAZY_PERIODS.items() for area, box in LAZY_AREAS.items()
        }

        def query(how: str, window: Window) -> DataFrame:
            if how == "stored":
                return queries.stored_cells(w.read(f"fact_cell_{size}m"), window)
            near = trajectories_of(w).where(F.col("start_date_id").between(window.start_id, window.end_id))
            return queries.lazy_cells(near, size, ("start_date_id", "trajectory_sub_id"), window)

        return cls(found, query, [warm_up(w, (size,))])
