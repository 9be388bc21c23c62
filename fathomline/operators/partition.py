"""Spatial partitions: a kd-tree over coarse cell counts, and containment of tiles in its leaves.

The tree is built on the driver from at most one row per 5 km cell of the domain, a number fixed by the domain.
"""

from __future__ import annotations

import heapq
import itertools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.schema import DOMAIN, TILE



@dataclass(frozen=True)
class Leaf:
    xmin: int
    ymin: int
    xmax: int
    ymax: int
    points: int
    level: int


class Counts:
    """Cell counts over the tiles of a domain, summed over any rectangle of tiles."""

    def __init__(self, counts: dict[tuple[int, int], int], domain: tuple[int, int, int, int]) -> None:
        if any(v % TILE for v in domain):
            raise ValueError(f"a domain's edges are multiples of {TILE}")
        self.origin = domain[0] // TILE, domain[1] // TILE
        grid = np.zeros((domain[2] // TILE - self.origin[0], domain[3] // TILE - self.origin[1]), np.int64)
        for (x, y), n in counts.items():
            if 0 <= x - self.origin[0] < grid.shape[0] and 0 <= y - self.origin[1] < grid.shape[1]:
                grid[x - self.origin[0], y - self.origin[1]] += n
        self.grid = grid

    def part(self, xmin: int, ymin: int, xmax: int, ymax: int) -> np.ndarray:
        (x0, y0), (a, b, c, d) = self.origin, (v // TILE for v in (xmin, ymin, xmax, ymax))
        return self.grid[a - x0 : c - x0, b - y0 : d - y0]


def halving_edge(columns: np.ndarray) -> int:
    """Before which column to cut so that both sides hold about half: bisection over the running totals.

    A cut with equal sides ends the search; else the cut is the edge next to the middle of the counts whose outer side is fuller."""
    totals = np.concatenate([[0], columns.cumsum()])
    surplus = 2 * totals - totals[-1]  # points before an edge less those behind it
    low, high = 0, len(columns)
    while high - low > 1:
        middle = (low + high) // 2
        if surplus[middle] == 0:
            return middle
        low, high = (low, middle) if surplus[middle] > 0 else (middle, high)
    return low if totals[low] > totals[-1] - totals[high] else high


def kd_tree(counts: dict[tuple[int, int], int], leaves: int, domain: tuple[int, int, int, int] = DOMAIN) -> list[Leaf]:
    """Cut the fullest leaf, of equals the oldest, until there are enough: even levels across x, odd ones across y, the
    other axis where a leaf is but one tile wide there."""
    table, born = Counts(counts, domain), itertools.count()
    root = Leaf(*domain, int(table.grid.sum()), 1)
    waiting, whole = [(-root.points, next(born), root)], []
    while waiting and len(waiting) + len(whole) < leaves:
        leaf = heapq.heappop(waiting)[2]
        tiles = table.part(leaf.xmin, leaf.ymin, leaf.xmax, leaf.ymax)
        axis = leaf.level % 2 if tiles.shape[leaf.level % 2] > 1 else 1 - leaf.level % 2
        if tiles.shape[axis] < 2:
            whole.append(leaf)
            continue
        edge = halving_edge(tiles.sum(1 - axis))
        for side in (slice(edge, None), slice(edge)):  # the upper part is the older
            first, last, _ = side.indices(tiles.shape[axis])
            box = [leaf.xmin, leaf.ymin, leaf.xmax, leaf.ymax]
            box[axis], box[axis + 2] = (box[axis] + TILE * at for at in (first, last))
            n = int((tiles[side] if axis == 0 else tiles[:, side]).sum())
            heapq.heappush(waiting, (-n, next(born), Leaf(*box, n, leaf.level + 1)))
    return whole + [x[2] for x in sorted(waiting)]


def build_partitions(facts: DataFrame, leaves: int = 400, domain: tuple[int, int, int, int] = DOMAIN) -> DataFrame:
    """(partition_id, xmin, ymin, xmax, ymax, points, level), numbered from 1, from 5 km cell facts (cell_x, cell_y)."""
    inside = F.col("cell_x").between(domain[0] // TILE, domain[2] // TILE - 1) & F.col("cell_y").between(domain[1] // TILE, domain[3] // TILE - 1)
    rows = facts.where(inside).groupBy("cell_x", "cell_y").count().collect()
    tree = kd_tree({(r[0], r[1]): r[2] for r in rows}, leaves, domain)
    return facts.sparkSession.createDataFrame([(i, x.xmin, x.ymin, x.xmax, x.ymax, x.points, x.level) for i, x in enumerate(tree, 1)], "partition_id int, xmin int, ymin int, xmax int, ymax int, points long, level int")


def assign_partition(boxes: DataFrame, partitions: DataFrame, names=("xmin", "ymin", "xmax", "ymax")) -> DataFrame:
    """The partition that covers each box, half-open at the upper edges: a box that only touches them from inside is covered,
    one that begins there is the neighbour's. Boxes in none are dropped.

    Partitions are spread over the tiles they meet and joined with the tile in which a box begins: an equality, so
    Spark may broadcast or deal out either side."""
    a, b, c, d = map(F.col, names)
    tile = lambda v: F.floor(v / TILE).cast("long")
    p = partitions.select("partition_id", *[F.col(k).alias(f"p_{k}") for k in ("xmin", "ymin", "xmax", "ymax")])
    for k in "xy":
        p = p.withColumn(f"p_tile_{k}", F.explode(F.sequence(tile(F.col(f"p_{k}min")), (F.ceil(F.col(f"p_{k}max") / TILE) - 1).cast("long"))))
    inside = (a >= F.col("p_xmin")) & (c <= F.col("p_xmax")) & (b >= F.col("p_ymin")) & (d <= F.col("p_ymax")) & (F.col("p_ymax") != b) & (F.col("p_xmax") != a)
    return boxes.join(p, (tile(a) == F.col("p_tile_x")) & (tile(b) == F.col("p_tile_y")) & inside).select(*[boxes[x] for x in boxes.columns], "partition_id")


def domain_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("spatial_domain", *map(float, DOMAIN))], "name string, xmin double, ymin double, xmax double, ymax double")
