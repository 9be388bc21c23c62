from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.functions import geo, keys, temporal
from fathomline.operators import cells, trajectory
from fathomline.operators.clean import clean
from fathomline.schema import AIS_CSV

T0 = datetime(2021, 3, 4, 10, 0, 0)


def report(seconds, sog, lat=57.3, lon=10.9, mmsi=219000001, **more):
    t = T0 + timedelta(seconds=seconds)
    row = {
        "timestamp_text": t.strftime("%d/%m/%Y %H:%M:%S"), "mobile_type": "Class A", "mmsi": mmsi, "lat": lat, "lon": lon, "nav_status": "Under way", "rot": 0.0, "sog": sog, "cog": 10.0, "heading": 20.0, "imo_text": "Unknown",
        "callsign": "OX", "name": "FERRY", "ship_type": "Passenger", "cargo_type": None, "width": 10.0, "length": 80.0, "position_fixing_device": "GPS", "draught": 3.0, "destination": "FAR", "eta_text": None, "data_source_type": "AIS", "a": 40.0, "b": 40.0, "c": 5.0, "d": 5.0,
    }
    return tuple((row | more)[f.name] for f in AIS_CSV)


def raw(spark, rows):
    return spark.createDataFrame(rows, AIS_CSV)


def sailing(start, n, every=60, lat=57.0, knots=10.0):
    """Reports along a meridian at a steady speed."""
    step = knots / 1.943844 * every / 111_300
    return [report(start + i * every, knots, lat=lat + i * step) for i in range(n)]


def lying(start, n, every=240, lat=57.0):
    return [report(start + i * every, 0.1, lat=lat) for i in range(n)]


@pytest.mark.parametrize(
    ("rows", "stopped", "moving"),
    [
        (lying(0, 12, 240), 1, 0),
        (lying(0, 5, 240) + lying(4 * 240 + 1080, 7, 240), 2, 0),
        (sailing(0, 11) + sailing(600 + 1800, 11, lat=57.05), 0, 2),
        (sailing(0, 11) + sailing(600 + 1800, 11, lat=57.05) + lying(3060, 6, 120, lat=57.078) + lying(3060 + 600 + 1000, 6, 120, lat=57.078), 2, 2),
    ],
)
def test_splitting(spark, rows, stopped, moving):
    built = trajectory.build(clean(raw(spark, rows))).collect()
    assert (sum(r.infer_stopped for r in built), sum(not r.infer_stopped for r in built)) == (stopped, moving)
    r = built[0]
    assert (r.start_date_id, r.imo, r.eta_date_id, r.nav_status, r.destination, r.ship_type, r.length) == (20210304, -1, -1, "Under way", "FAR", "Passenger", 80.0)


def test_unscaled_coordinates_keep_all_points():
    """Positions far outside the projection give NaN distances, whose tests are all false."""
    kept, sog = trajectory.keep_points(np.array([0.0, 60, 120]), np.array([math.nan] * 3), np.array([math.nan] * 3), np.array([0.1, 0.2, 0.3]))
    assert kept.all() and list(sog) == [0.1, 0.2, 0.3]


@pytest.mark.parametrize(
    ("end", "seconds", "limit", "outlier"),
    [((0, 0), 0, 100, True), ((50_000, 50_000), 300, 1, True), ((3_000, 3_000), 300, 100, False)],
)
def test_outlier_verdict(end, seconds, limit, outlier):
    assert trajectory.is_outlier(*end, 0, 0, seconds, math.nan, limit)[0] is outlier


def test_sog_is_repaired_but_not_of_the_first():
    kept, sog = trajectory.keep_points(np.array([0.0, 100, 200]), np.array([0.0, 100, 200]), np.zeros(3), np.array([math.nan, math.nan, 1.5]))
    assert kept.all() and math.isnan(sog[0]) and sog[1:] == pytest.approx([1.943844, 1.5])


@pytest.mark.parametrize(("gap", "parts"), [(899, 1), (900, 2), (901, 2)])
def test_gap(spark, gap, parts):
    rows = [(1, T0 + timedelta(seconds=s), 5.0) for s in (0, 1, 2, 2 + gap, 3 + gap, 4 + gap)]
    df = spark.createDataFrame(rows, "mmsi int, ts timestamp, sog double")
    assert trajectory.segments(df, ("mmsi",)).select("segment").distinct().count() == parts


@pytest.mark.parametrize("n", [1, 2])
def test_short_segments_go(spark, n):
    df = spark.createDataFrame([(1, T0 + timedelta(seconds=i), 5.0) for i in range(n)], "mmsi int, ts timestamp, sog double")
    assert trajectory.segments(df, ("mmsi",)).count() == 0


@pytest.mark.parametrize(("speeds", "stopped"), [((0.5,) * 4, False), ((0.49,) * 4, True), ((None,) * 4, True), ((float("nan"),) * 4, True), ((0.4, 0.6, 0.4, 0.6), False)])
def test_stop_speed(spark, speeds, stopped):
    df = spark.createDataFrame([(1, T0 + timedelta(seconds=100 * i), s) for i, s in enumerate(speeds)], "mmsi int, ts timestamp, sog double")
    assert {r.infer_stopped for r in trajectory.segments(df, ("mmsi",)).collect()} == {stopped}


def machine(points, gap=900, stop=300, slow=0.5):
    """A state machine over (seconds, sog): stop runs of slow points that last long enough, cut at gaps."""
    out, i, n = [], 0, len(points)
    is_slow = [not (s is not None and s >= slow) for _, s in points]
    state, now = None, []
    while i < n:
        j = i
        while j < n and is_slow[j] == is_slow[i]:
            j += 1
        stopped = is_slow[i] and points[j - 1][0] - points[i][0] >= stop
        for k in range(i, j):
            if now and (stopped != state or points[k][0] - points[now[-1]][0] >= gap):
                out.append((state, now))
                now = []
            state = stopped
            now.append(k)
        i = j
    out.append((state, now))
    return [(s, x) for s, x in out if len(x) >= 3]


def test_segments_match_state_machine(spark):
    rng, rows, want = random.Random(5), [], {}
    for ship in range(60):
        t, points = 0, []
        for _ in range(rng.randint(1, 40)):
            t += rng.choice([1, 60, 150, 299, 300, 301, 899, 900])
            points.append((t, rng.choice([0.0, 0.49, 0.5, 5.0, None])))
        rows += [(ship, T0 + timedelta(seconds=s), v) for s, v in points]
        want[ship] = sorted((s, [points[k][0] for k in x]) for s, x in machine(points))
    got = {s: [] for s in want}
    df = trajectory.segments(spark.createDataFrame(rows, "mmsi int, ts timestamp, sog double"), ("mmsi",))
    for r in df.groupBy("mmsi", "segment", "infer_stopped").agg(F.sort_array(F.collect_list("ts")).alias("t")).collect():
        got[r.mmsi].append((r.infer_stopped, [int((x - T0).total_seconds()) for x in r.t]))
    assert {k: sorted(v) for k, v in got.items()} == want


def test_mode_skips_nulls_and_joint_mode_keeps_them(spark):
    df = spark.createDataFrame([("a", None), ("b", True), ("b", None), (None, None), (None, None)], "food string, good boolean")
    r = df.agg(trajectory.most_frequent(F.col("food")).alias("m"), F.mode(F.struct("food", "good"), True).alias("j")).first()
    assert r.m == "b" and tuple(r.j) == (None, None)


@pytest.mark.parametrize(("values", "left"), [((1.0, None, 2.0, 2.0, 3.0, 3.0), [1.0, 2.0, 3.0, 3.0]), ((None, None), []), ((4.0, 4.0, 4.0), [4.0, 4.0]), ((4.0,), [4.0])])
def test_step_compression(spark, values, left):
    df = spark.createDataFrame([([(T0 + timedelta(days=i), v) for i, v in enumerate(values)],)], "s array<struct<t:timestamp,v:double>>")
    assert [x.v for x in df.select(temporal.compress_steps(F.col("s")).alias("s")).first().s] == left


@pytest.mark.parametrize(("x", "y", "want"), [(1.0, 5.0, 6.0), (2.0, -1.0, 2.0), (-1.0, 3.0, 3.0), (-1.0, -1.0, -1.0), (None, 3.0, 3.0)])
def test_size_from_parts(spark, x, y, want):
    df = spark.createDataFrame([(None, x, y)], "w double, x double, y double")
    assert df.select(keys.size_from_parts(F.col("w"), F.col("x"), F.col("y")).alias("s")).first().s == want


def test_keys_of_null(spark):
    df = spark.createDataFrame([(None,), (datetime(2022, 9, 1, 23, 59, 7),)], "t timestamp")
    assert [tuple(r) for r in df.select(keys.date_key(F.col("t")), keys.time_key(F.col("t"))).collect()] == [(-1, -1), (20220901, 235907)]


def test_projection_reference_points(spark):
    df = spark.createDataFrame([(10.0, 52.0), (10.921933, 57.298437)], "lon double, lat double")
    x, y = geo.project(F.col("lon"), F.col("lat"))
    rows = [(round(r.x, 3), round(r.y, 3)) for r in df.select(x.alias("x"), y.alias("y")).collect()]
    assert rows == [(4000000.0, 2800000.0), (4054026.399, 3371385.289)]


def test_cleaning(spark):
    rows = [report(0, 1.0), report(1, 1.0, width=None), report(2, 1.0, draught=None), report(3, 1.0, draught=28.5), report(4, 1.0, mmsi=111500000), report(5, 1.0, mobile_type="Base Station"), report(6, 1.0, lat=10.0), report(7, 1.0, mmsi=99999999)]
    ring = geo.box_polygon(5.0, 50.0, 15.0, 60.0)
    out = clean(raw(spark, rows), ring).select("ts", "imo").collect()
    assert sorted((r.ts - T0).seconds for r in out) == [0, 2] and {r.imo for r in out} == {None}


def test_simplify_keeps_ends_and_turns(spark):
    pts = [(T0 + timedelta(seconds=10 * i), 10.0 * i, 0.0) for i in range(10)] + [(T0 + timedelta(seconds=100 + 10 * i), 90.0, 50.0 * i) for i in range(1, 5)]
    df = spark.createDataFrame([(1, pts), (2, pts[:2]), (3, None)], "id int, trajectory array<struct<t:timestamp,x:double,y:double>>")
    out = {r.id: r.trajectory for r in trajectory.simplify(df).collect()}
    assert out[1][0].x == 0.0 and out[1][-1].y == 200.0 and len(out[1]) < len(pts) and any(p.x == 90.0 and p.y == 0.0 for p in out[1])
    assert len(out[2]) == 2 and out[3] is None


def test_crossings_keep_length_and_time(spark):
    rng, rows = random.Random(3), []
    for i in range(20):
        x, y, t, pts = rng.uniform(0, 400), rng.uniform(0, 400), 0.0, []
        for _ in range(rng.randint(2, 12)):
            pts.append((T0 + timedelta(seconds=t), x, y))
            kind = rng.random()
            x, y = (x, y) if kind < 0.1 else (x + rng.choice([0, 50, 100, rng.uniform(-300, 300)]), y + rng.choice([0, 50, -100, rng.uniform(-300, 300)]))
            t += rng.randint(1, 600)
        rows.append((i, pts))
    df = spark.createDataFrame(rows, "id int, trajectory array<struct<t:timestamp,x:double,y:double>>")
    c = cells.crossings(df, 50, ("id",)).collect()
    for i, pts in rows:
        mine = sorted((r for r in c if r.id == i), key=lambda r: r.crossing)
        length = sum(math.hypot(b[1] - a[1], b[2] - a[2]) for a, b in zip(pts, pts[1:], strict=False))
        assert sum(r.metres for r in mine) == pytest.approx(length, abs=1e-6)
        assert sum(r.t1 - r.t0 for r in mine) == pytest.approx((pts[-1][0] - pts[0][0]).total_seconds(), abs=1e-3)
        for a, b in zip(mine, mine[1:], strict=False):
            assert (a.x1, a.y1) == pytest.approx((b.x0, b.y0), abs=1e-6)
            assert max(abs(a.cell_x - b.cell_x), abs(a.cell_y - b.cell_y)) == 1


def test_direction_and_deltas(spark):
    df = spark.createDataFrame([(50.0, 10.0), (0.1, 0.1), (25.0, 25.0), (25.0, 49.9)], "x double, y double")
    d = cells.direction(F.col("x"), F.col("y"), F.lit(0), F.lit(0), 50)
    assert [r[0] for r in df.select(d).collect()] == ["East", "South", "Unknown", "North"]
    v = spark.createDataFrame([([350.0, 10.0, 10.0],), ([5.0],), (None,), ([0.0, 90.0, 350.0],)], "v array<double>")
    assert [r[0] for r in v.select(temporal.circular_delta(F.col("v"))).collect()] == [20.0, 0.0, 0.0, 190.0]
    assert [r[0] for r in v.select(temporal.delta(F.col("v"))).collect()] == [340.0, 0.0, 0.0, 350.0]
    assert [r[0] for r in v.select(temporal.delta(F.col("v"), absolute=False)).collect()] == [-340.0, 0.0, 0.0, 350.0]
