"""Cell crossings: trajectories cut by a grid, without a grid table.

A cell is floor(x / size), floor(y / size). Each pair of neighbouring points is cut where it meets grid lines, by
arithmetic on the row alone; pieces in a row with the same cell are one crossing. No join with cells, so the
plan is an explode and one aggregation per trajectory whatever the grid's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fathomline.functions.geo import azimuth
from fathomline.functions.keys import date_key, lowest_key, time_key
from fathomline.functions.temporal import circular_delta, least_step, steps_within
from fathomline.schema import CELL_KNOTS, EDGE_METRES, TILE


def cell_of(v: Column, size: int) -> Column:
    return F.floor(v / size).cast("long")


def parent_of(cell: Column, size: int, parent: int) -> Column:
    """The id of the coarser cell, by truncating division."""
    n = parent // size
    return ((cell - cell % n) / n).cast("long")


def _cuts(a: Column, b: Column, size: int) -> Column:
    """Places u in (0, 1) where a + u (b - a) meets a multiple of size, each as an exact line index over the difference."""
    lo, hi = F.least(a, b), F.greatest(a, b)
    first, last = F.floor(lo / size) + 1, F.ceil(hi / size) - 1
    none = F.array().cast("array<double>")
    return F.when((a == b) | (first > last), none).otherwise(F.transform(F.sequence(first, last), lambda k: (k * size - a) / (b - a)))


def pieces(df: DataFrame, size: int, points: str = "trajectory", keep: tuple[str, ...] = (), once: tuple[str, ...] = ()) -> DataFrame:
    """One row per piece: the kept columns, ``leg``, ``part``, ends (t in seconds, x, y) and cell; the columns of
    ``once`` come with a trajectory's first piece only and are null in the others."""
    n = F.size(points)
    legs = F.arrays_zip(F.slice(points, 1, F.greatest(n - 1, F.lit(0))).alias("p"), F.slice(points, 2, F.greatest(n - 1, F.lit(0))).alias("q"))
    seconds = lambda c: F.unix_micros(c) / 1e6
    df = df.where(n >= 2).select(*keep, *once, F.posexplode(legs).alias("leg", "l"))
    df = df.select(*keep, *[F.when(F.col("leg") == 0, F.col(c)).alias(c) for c in once], "leg", *[F.col(f"l.{e}.{c}").alias(f"{e}{c}") for e in "pq" for c in "xy"], seconds(F.col("l.p.t")).alias("pt"), seconds(F.col("l.q.t")).alias("qt"))
    us = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), _cuts(F.col("px"), F.col("qx"), size), _cuts(F.col("py"), F.col("qy"), size))))
    df = df.withColumn("us", F.filter(us, lambda u: (u >= 0) & (u <= 1)))
    m = F.size("us") - 1
    df = df.select(*keep, *once, "leg", "px", "py", "qx", "qy", "pt", "qt", F.posexplode(F.arrays_zip(F.slice("us", 1, m).alias("u"), F.slice("us", 2, m).alias("v"))).alias("part", "s"))
    at = lambda c, u: F.when(u == 1, F.col(f"q{c}")).otherwise(F.col(f"p{c}") + u * (F.col(f"q{c}") - F.col(f"p{c}")))
    u, v = F.col("s.u"), F.col("s.v")
    middle = (u + v) / 2
    return df.select(
        *keep, *[F.when(F.col("part") == 0, F.col(c)).alias(c) for c in once], "leg", "part", *[at(c, u).alias(f"{c}0") for c in "xyt"], *[at(c, v).alias(f"{c}1") for c in "xyt"],
        cell_of(at("x", middle), size).alias("cell_x"), cell_of(at("y", middle), size).alias("cell_y"),
    )


def crossings(df: DataFrame, size: int, keys: tuple[str, ...], points: str = "trajectory", once: tuple[str, ...] = ()) -> DataFrame:
    """One row per crossing: keys, cell, first and last point (to the millimetre), length, the set of courses, and the trajectory's columns ``once``.

    ``keys`` name a trajectory; its pieces are bounded by its own length. All steps share one dealing by the keys: the columns
    ``once`` travel with the first piece and are spread over the crossings afterwards, so no join brings them back."""
    p = pieces(df, size, points, keys, once)
    by = W.partitionBy(*keys).orderBy("leg", "part")
    same = (F.col("cell_x") == F.lag("cell_x").over(by)) & (F.col("cell_y") == F.lag("cell_y").over(by))
    p = p.withColumn("enters", (~F.coalesce(same, F.lit(False))).cast("int"))
    p = p.withColumn("crossing", F.sum("enters").over(by.rowsBetween(W.unboundedPreceding, 0)))
    p = p.withColumns({"metres": F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")), "course": azimuth(F.round(F.col("x1") - F.col("x0"), 6), F.round(F.col("y1") - F.col("y0"), 6))})
    at = F.struct("leg", "part")
    out = p.groupBy(*keys, "crossing", "cell_x", "cell_y").agg(
        *[F.round(F.min_by(f"{c}0", at), 3).alias(f"{c}0") for c in "xy"], F.min_by("t0", at).alias("t0"),
        *[F.round(F.max_by(f"{c}1", at), 3).alias(f"{c}1") for c in "xy"], F.max_by("t1", at).alias("t1"),
        F.sum("metres").alias("metres"), F.array_sort(F.collect_set(F.round("course", 6))).alias("courses"), *[F.first(c, ignorenulls=True).alias(c) for c in once],
    )
    spread = W.partitionBy(*keys).orderBy("crossing").rowsBetween(W.unboundedPreceding, 0)
    return out.withColumns({c: F.first(c, ignorenulls=True).over(spread) for c in once}) if once else out


def direction(x: Column, y: Column, cell_x: Column, cell_y: Column, size: int) -> Column:
    """The edge within EDGE_METRES that is nearest, numerically; of several: South, North, East, West; none: Unknown."""
    return lowest_key({"South": F.abs(y - cell_y * size), "North": F.abs((cell_y + 1) * size - y), "East": F.abs((cell_x + 1) * size - x), "West": F.abs(x - cell_x * size)}, F.lit(EDGE_METRES))


DIRECTIONS = ("North", "South", "East", "West", "Unknown")


def direction_id(entry: Column, leave: Column) -> Column:
    """The key in the 5 x 5 direction dimension, numbered from 1 in the order of DIRECTIONS; no join is needed for it."""
    place = lambda c: F.array_position(F.array(*map(F.lit, DIRECTIONS)), c) - 1
    return (place(entry) * 5 + place(leave) + 1).cast("int")


def fact_cell(trajectories: DataFrame, size: int, keys: tuple[str, ...], carry: tuple[str, ...] = ("ship_id", "nav_status_id", "infer_stopped"), window: Column | None = None) -> DataFrame:
    """Cell facts of trajectories (arrays ``trajectory``, ``heading``, ``draught``).

    ``window``, a predicate on the trajectory columns, bounds what is cut at all (the on-the-fly variant).
    """
    df = trajectories if window is None else trajectories.where(window)
    carry = tuple(c for c in carry if c not in keys)
    cut = crossings(df, size, keys, once=(*carry, "heading", "draught"))
    second = lambda c: F.timestamp_seconds(F.floor(c))
    rows = cut.withColumns({"tmin": second(F.col("t0")), "tmax": second(F.col("t1"))})
    rows = rows.withColumn("headings", steps_within(F.col("heading"), F.col("tmin"), F.col("tmax")))
    x, y = F.col("cell_x"), F.col("cell_y")
    edge = lambda e: direction(F.col(f"x{e}"), F.col(f"y{e}"), x, y, size)
    seconds = F.unix_seconds("tmax") - F.unix_seconds("tmin")
    return rows.select(
        *keys, *carry, "cell_x", "cell_y", "crossing",
        date_key(F.col("tmin")).alias("entry_date_id"), time_key(F.col("tmin")).alias("entry_time_id"), date_key(F.col("tmax")).alias("exit_date_id"), time_key(F.col("tmax")).alias("exit_time_id"),
        direction_id(edge("0"), edge("1")).alias("direction_id"),
        (F.col("metres") / F.greatest(seconds, F.lit(1)) * CELL_KNOTS).alias("sog"),
        F.when(F.size("headings") > 0, circular_delta(F.col("headings"))).otherwise(F.lit(-1.0)).alias("delta_heading"),
        least_step(F.col("draught"), F.col("tmin"), F.col("tmax")).alias("draught"), circular_delta(F.col("courses")).alias("delta_cog"),
        (x * size).cast("double").alias("xmin"), (y * size).cast("double").alias("ymin"), ((x + 1) * size).cast("double").alias("xmax"), ((y + 1) * size).cast("double").alias("ymax"), "tmin", "tmax",
    )


def used_cells(facts: DataFrame, size: int, parents: tuple[int, ...] = (TILE,)) -> DataFrame:
    """Distinct cells of facts with the ids of their parents (the dimension, loaded on demand)."""
    cells = facts.select("cell_x", "cell_y").distinct()
    cols = {f"parent_{p}_{a}": parent_of(F.col(f"cell_{a}"), size, p) for p in parents for a in "xy"}
    return cells.withColumns(cols)


def square_grid(spark, size: int, domain: tuple[int, int, int, int]) -> DataFrame:
    """All cells that meet a domain, as ids and boxes; for coarse sizes."""
    x0, y0, x1, y1 = (domain[0] // size, domain[1] // size, -(-domain[2] // size), -(-domain[3] // size))
    df = spark.range((x1 - x0) * (y1 - y0)).select((F.col("id") % (x1 - x0) + x0).alias("cell_x"), (F.floor(F.col("id") / (x1 - x0)) + y0).alias("cell_y"))
    return df.withColumns({"xmin": F.col("cell_x") * size, "ymin": F.col("cell_y") * size, "xmax": (F.col("cell_x") + 1) * size, "ymax": (F.col("cell_y") + 1) * size})
