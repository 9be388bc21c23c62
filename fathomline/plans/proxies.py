"""Queries of the engine's operators over the driver's tables, with their SQL.

``events`` is read as a point stream: user_id is the ship, value its speed, event_type its status, props.k its heading,
and (value * 1000, k * 1000) its place. Thresholds are scaled to that stream's gaps of hours. The TPC-H tables serve
as a star schema. Each query reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fathomline.functions import calendar, geo, keys, temporal
from fathomline.operators import cells, clean, dims, heatmap, partition, trajectory
from fathomline.plans import queries as analytic
from fathomline.plans.warehouse import insert_new, without_days
from fathomline.streaming.ingest import sessions

GAP, STOP, SLOW, FAST = 12 * 3600, 6 * 3600, 30.0, 2.0

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

PTS = """pts AS (SELECT event_id, ts, user_id, event_type, value, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
  value * 1000 AS x, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) * 1000.0 AS y FROM events)"""
SEG = f"""{PTS}, s0 AS (SELECT *, NOT (value >= {SLOW}) AS slow FROM pts),
s1 AS (SELECT *, CASE WHEN slow <> lag(slow) OVER w THEN 1 ELSE 0 END AS c FROM s0 WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s2 AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM s1),
s3 AS (SELECT *, slow AND epoch_us(max(ts) OVER (PARTITION BY user_id, run)) - epoch_us(min(ts) OVER (PARTITION BY user_id, run)) >= {STOP * 1000000} AS infer_stopped FROM s2),
s4 AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR infer_stopped <> lag(infer_stopped) OVER w OR epoch_us(ts) - epoch_us(lag(ts) OVER w) >= {GAP * 1000000} THEN 1 ELSE 0 END AS b
  FROM s3 WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s5 AS (SELECT *, CAST(sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM s4),
seg AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY user_id, segment) AS n FROM s5) WHERE n >= 3)"""


def query(sql: str | None = None) -> Callable:
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream of points; times are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    k = F.get_json_object("props", "$.k").cast("int")
    return read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", k.alias("k"), (F.col("value") * 1000).alias("x"), (k * F.lit(1000.0)).alias("y"))


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectory.segments(points(spark, sf_dir), ("user_id",), sog="value", order=("event_id",), gap=GAP, stop_seconds=STOP, stop_knots=SLOW)


def arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trajectory for each segment."""
    step = lambda c: F.array_sort(F.collect_list(F.struct(F.col("ts").alias("t"), F.col(c).cast("double").alias("v"))))
    return marked(spark, sf_dir).groupBy("user_id", "segment", "infer_stopped").agg(
        F.array_sort(F.collect_list(F.struct(F.col("ts").alias("t"), "x", "y"))).alias("trajectory"), step("k").alias("heading"), step("value").alias("draught")
    )


# -- keys and scalar functions


@query("""SELECT event_id, CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS date_id, CAST(hour(ts) * 10000 + minute(ts) * 100 + CAST(floor(second(ts)) AS INTEGER) AS INTEGER) AS time_id,
CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(epoch_us(date_trunc('second', ts)) // 1000000 AS BIGINT) AS back, CAST(hour(ts) * 10000 AS INTEGER) AS hour_id FROM events""")
def smart_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, t = keys.date_key(F.col("ts")), keys.time_key(F.col("ts"))
    return read(spark, sf_dir, "events").select("event_id", d.alias("date_id"), t.alias("time_id"), keys.key_date(d).cast("string").alias("day"), F.unix_seconds(keys.key_timestamp(d, t)).alias("back"), keys.hour_key(keys.hour_of_key(t)).alias("hour_id"))


@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (l_tax < 0.06 OR l_tax IS NULL) AND l_quantity < 45 AND l_discount < 0.09
AND l_partkey > 10 AND l_partkey < 1900 AND NOT (l_partkey > 110 AND l_partkey < 120) AND l_returnflag IN ('A', 'N')""")
def clean_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``plausible`` itself, over line items that stand for reports, with limits of their scale."""
    limits = clean.Limits(0.06, 45, 0.09, (10, 1900), (110, 120), ("A", "N"))
    keep = clean.plausible(limits, ("l_tax", "l_quantity", "l_discount", "l_partkey", "l_returnflag"))
    return read(spark, sf_dir, "lineitem").where(keep).select("l_orderkey", "l_linenumber", "l_quantity")


@query("""SELECT p_partkey, CAST(CASE WHEN p_size % 3 = 0 THEN CAST(p_size AS DOUBLE) WHEN p_size % 5 = 0 AND p_size % 7 = 0 THEN -1.0 WHEN p_size % 5 = 0 THEN CAST(p_size % 5 AS DOUBLE)
WHEN p_size % 7 = 0 THEN CAST(p_size % 7 AS DOUBLE) ELSE CAST(p_size % 5 + p_size % 7 AS DOUBLE) END AS DOUBLE) AS length FROM part""")
def dim_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("p_size")
    part = lambda n: F.when(s % n == 0, -1.0).otherwise((s % (12 - n)).cast("double"))
    return read(spark, sf_dir, "part").select("p_partkey", keys.size_from_parts(F.when(s % 3 == 0, s.cast("double")), part(5), part(7)).alias("length"))


@query("""SELECT r.rank AS mid, CAST(count(*) AS BIGINT) AS ships FROM (SELECT coalesce(n.n_name, 'Unknown') AS rank FROM
(SELECT CAST(substring(CAST(c_custkey + 100000000 AS VARCHAR), 1, 3) AS INTEGER) - 100 + c_nationkey AS k FROM customer) c LEFT JOIN nation n ON n.n_nationkey = c.k) r GROUP BY 1""")
def mid_prefix_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select((keys.mid(F.col("c_custkey") + 100000000) - 100 + F.col("c_nationkey")).alias("k"))
    j = c.join(read(spark, sf_dir, "nation"), F.col("k") == F.col("n_nationkey"), "left")
    return j.groupBy(F.coalesce("n_name", F.lit("Unknown")).alias("mid")).agg(F.count("*").alias("ships"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN least(l_discount, l_tax, l_quantity / 1000, 0.02) = l_discount THEN 'South' WHEN least(l_discount, l_tax, l_quantity / 1000, 0.02) = l_tax THEN 'North'
WHEN least(l_discount, l_tax, l_quantity / 1000, 0.02) = l_quantity / 1000 THEN 'East' ELSE 'Unknown' END AS edge FROM lineitem""")
def lowest_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = keys.lowest_key({"South": F.col("l_discount"), "North": F.col("l_tax"), "East": F.col("l_quantity") / 1000}, F.lit(0.02))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", e.alias("edge"))


@query("""SELECT l_orderkey, l_linenumber, CAST(CASE WHEN a >= 2e10 THEN 5000 WHEN a >= 2e9 THEN 1000 WHEN a >= 2e8 THEN 200 ELSE 50 END AS INTEGER) AS cell_size
FROM (SELECT *, l_extendedprice * l_extendedprice * l_quantity AS a FROM lineitem)""")
def resolution_by_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("l_extendedprice") * F.col("l_extendedprice") * F.col("l_quantity")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", keys.resolution_for(a).alias("cell_size"))


@query("""SELECT l_orderkey, l_linenumber, round(l_discount * 100 - floor(l_discount * 100 / 3) * 3, 6) AS real_mod, CAST(l_partkey // 100 AS BIGINT) AS parent, rint(l_quantity / 2) AS even
FROM lineitem""".replace("rint(l_quantity / 2)", "round_even(l_quantity / 2, 0)"))
def number_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(keys.real_mod(F.col("l_discount") * 100, 3.0), 6).alias("real_mod"), keys.int_div(F.col("l_partkey"), 100).alias("parent"), F.rint(F.col("l_quantity") / 2).alias("even"))


# -- filters


@query("""SELECT event_id FROM events WHERE CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) BETWEEN 20240105 AND 20240120 AND event_type = ANY(['click', 'view', 'purchase'])""")
def membership_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").where(keys.date_key(F.col("ts")).between(20240105, 20240120) & F.col("event_type").isin("click", "view", "purchase")).select("event_id")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_partkey, l_suppkey) IN (SELECT p_partkey, s_suppkey FROM part, supplier WHERE p_size = s_nationkey)""")
def row_value_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = read(spark, sf_dir, "part").join(read(spark, sf_dir, "supplier"), F.col("p_size") == F.col("s_nationkey"))
    pairs = pairs.select(F.col("p_partkey").alias("l_partkey"), F.col("s_suppkey").alias("l_suppkey"))
    return read(spark, sf_dir, "lineitem").join(pairs, ["l_partkey", "l_suppkey"], "left_semi").select("l_orderkey", "l_linenumber")


@query(f"""WITH {PTS}, b AS (SELECT user_id, min(ts) AS tmin, max(ts) AS tmax, min(x) AS xmin, max(x) AS xmax FROM pts GROUP BY user_id)
SELECT user_id, tmax >= TIMESTAMP '2024-01-03' AND tmin < TIMESTAMP '2024-01-29' AS half_open, tmax >= TIMESTAMP '2024-01-03' AND tmin <= TIMESTAMP '2024-01-29' AS closed,
CAST(floor(xmin / 5000) AS BIGINT) >= 12345 // 5000 AND CAST(floor(xmin / 5000) AS BIGINT) < 27499 // 5000 AS tiles FROM b""")
def window_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = points(spark, sf_dir).groupBy("user_id").agg(F.min("ts").alias("tmin"), F.max("ts").alias("tmax"), F.min("x").alias("xmin"))
    at = lambda s: F.lit(s).cast("timestamp")
    cell = cells.cell_of(F.col("xmin"), 5000)
    meets = lambda closed: (F.col("tmax") >= at("2024-01-03")) & ((F.col("tmin") <= at("2024-01-29")) if closed else (F.col("tmin") < at("2024-01-29")))
    return b.select("user_id", meets(False).alias("half_open"), meets(True).alias("closed"), ((cell >= 12345 // 5000) & (cell < 27499 // 5000)).alias("tiles"))


@query(f"""WITH {PTS} SELECT event_id FROM pts WHERE x > 10000 AND y > 0 AND y < 80000 AND x < 90000 - y""")
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = points(spark, sf_dir)
    return p.where(geo.inside_polygon(F.col("x"), F.col("y"), [(10000.0, 0.0), (90000.0, 0.0), (10000.0, 80000.0)])).select("event_id")


# -- trajectories


@query(f"WITH {SEG} SELECT event_id, user_id, segment, infer_stopped FROM seg")
def trajectory_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked(spark, sf_dir).select("event_id", "user_id", "segment", "infer_stopped")


@query(f"""WITH {SEG} SELECT user_id, segment, infer_stopped, CAST(count(*) AS BIGINT) AS points, CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS BIGINT) AS duration_us,
CAST(year(min(ts)) * 10000 + month(min(ts)) * 100 + day(min(ts)) AS INTEGER) AS start_date_id FROM seg GROUP BY 1, 2, 3""")
def segment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked(spark, sf_dir).groupBy("user_id", "segment", "infer_stopped").agg(
        F.count("*").alias("points"), (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))).alias("duration_us"), keys.date_key(F.min("ts")).alias("start_date_id")
    )


@query(f"""WITH {SEG}, m AS (SELECT user_id, segment, k, count(*) AS c FROM seg GROUP BY ALL), j AS (SELECT user_id, segment, event_type, k, count(*) AS c FROM seg GROUP BY ALL),
mm AS (SELECT user_id, segment, k, row_number() OVER (PARTITION BY user_id, segment ORDER BY c DESC, k) AS r FROM m),
jj AS (SELECT user_id, segment, event_type, k, row_number() OVER (PARTITION BY user_id, segment ORDER BY c DESC, event_type, k) AS r FROM j)
SELECT mm.user_id, mm.segment, mm.k AS heading, jj.event_type AS status, jj.k AS status_k FROM mm JOIN jj ON mm.user_id = jj.user_id AND mm.segment = jj.segment WHERE mm.r = 1 AND jj.r = 1""")
def segment_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = marked(spark, sf_dir).groupBy("user_id", "segment").agg(trajectory.most_frequent(F.col("k")).alias("heading"), F.mode(F.struct("event_type", "k"), True).alias("j"))
    return g.select("user_id", "segment", "heading", F.col("j.event_type").alias("status"), F.col("j.k").alias("status_k"))


@query(f"""WITH RECURSIVE {PTS}, o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, epoch_us(ts) / 1e6 AS t FROM pts),
f AS (SELECT user_id, i, event_id, t AS pt, x AS px, y AS py, value AS sog, TRUE AS kept FROM o WHERE i = 1
  UNION ALL
  SELECT user_id, i, event_id, CASE WHEN bad THEN pt ELSE t END, CASE WHEN bad THEN px ELSE x END, CASE WHEN bad THEN py ELSE y END, sog, NOT bad FROM (
    SELECT *, t = pt OR sog > {FAST} AS bad FROM (
      SELECT o.user_id, o.i, o.event_id, o.t, o.x, o.y, f.pt, f.px, f.py,
        CASE WHEN o.t = f.pt THEN o.value WHEN abs(o.value - sqrt((o.x - f.px) ** 2 + (o.y - f.py) ** 2) / (o.t - f.pt) * 1.943844) >= 2 THEN sqrt((o.x - f.px) ** 2 + (o.y - f.py) ** 2) / (o.t - f.pt) * 1.943844 ELSE o.value END AS sog
      FROM f JOIN o ON o.user_id = f.user_id AND o.i = f.i + 1)))
SELECT event_id, round(sog, 6) AS sog FROM f WHERE kept""")
def outlier_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = points(spark, sf_dir).select("event_id", "user_id", "ts", "x", "y", F.col("value").alias("sog"))
    return trajectory.drop_outliers(p, ("user_id",), order=("event_id",), limit=FAST).select("event_id", F.round("sog", 6).alias("sog"))


@query(f"""WITH {PTS} SELECT event_id FROM (SELECT event_id, k, lag(k) OVER w AS before, lead(event_id) OVER w AS next FROM pts WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE before IS NULL OR k <> before OR next IS NULL""")
def tfloat_compress(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = points(spark, sf_dir).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", F.col("k").cast("double").alias("v")))).alias("s"))
    kept = temporal.compress_steps(F.transform("s", lambda r: F.struct(r["event_id"].alias("t"), r["v"].alias("v"))))
    return p.select(F.explode(kept).alias("r")).select(F.col("r.t").alias("event_id"))


@query(f"""WITH {PTS}, d AS (SELECT DISTINCT user_id, k * 7 AS v FROM pts), g AS (SELECT user_id, v, v - lag(v) OVER (PARTITION BY user_id ORDER BY v) AS d FROM d)
SELECT user_id, coalesce(sum(least(d - floor(d / 360.0) * 360, -d - floor(-d / 360.0) * 360)), 0.0) AS turn FROM g GROUP BY user_id""")
def circular_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points(spark, sf_dir).groupBy("user_id").agg(F.collect_list((F.col("k") * 7).cast("double")).alias("v")).select("user_id", temporal.circular_delta(F.col("v")).alias("turn"))


@query(f"""WITH {SEG}, l AS (SELECT user_id, segment, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS d FROM seg WINDOW w AS (PARTITION BY user_id, segment ORDER BY ts, x, y))
SELECT user_id, segment, round(coalesce(sum(d), 0), 4) AS metres FROM l GROUP BY 1, 2""")
def path_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrays(spark, sf_dir).select("user_id", "segment", F.round(geo.path_length(F.col("trajectory")), 4).alias("metres"))


@query(f"""WITH RECURSIVE {SEG},
p AS MATERIALIZED (SELECT user_id, segment, row_number() OVER (PARTITION BY user_id, segment ORDER BY ts, x, y) AS i, CAST(epoch_us(ts) * 1000 AS DOUBLE) / 1e9 AS t, x, y FROM seg),
chord AS (
  SELECT user_id, segment, min(i) AS a, max(i) AS b FROM p GROUP BY 1, 2
  UNION ALL
  SELECT user_id, segment, unnest([a, far]) AS a, unnest([far, b]) AS b FROM (
    SELECT user_id, segment, a, b, first(i ORDER BY d DESC, i) AS far, max(d) AS most FROM (
      SELECT c.user_id, c.segment, c.a, c.b, m.i, (m.t - f.t) / (CASE WHEN l.t = f.t THEN 1 ELSE l.t - f.t END) AS u,
             sqrt((m.x - f.x - u * (l.x - f.x)) ** 2 + (m.y - f.y - u * (l.y - f.y)) ** 2) AS d
      FROM chord c JOIN p f ON f.user_id = c.user_id AND f.segment = c.segment AND f.i = c.a JOIN p l ON l.user_id = c.user_id AND l.segment = c.segment AND l.i = c.b
      JOIN p m ON m.user_id = c.user_id AND m.segment = c.segment AND m.i > c.a AND m.i < c.b) GROUP BY user_id, segment, a, b)
  WHERE most > 10000.0),
ends AS (SELECT user_id, segment, a AS i FROM chord UNION SELECT user_id, segment, b FROM chord)
SELECT n.user_id, n.segment, n.points, k.kept FROM (SELECT user_id, segment, CAST(count(*) AS INTEGER) AS points FROM p GROUP BY 1, 2) n
JOIN (SELECT user_id, segment, CAST(count(*) AS INTEGER) AS kept FROM ends GROUP BY 1, 2) k ON n.user_id = k.user_id AND n.segment = k.segment""")
def simplified_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trajectory.simplify(arrays(spark, sf_dir).withColumn("points", F.size("trajectory")), metres=10000.0)
    return t.select("user_id", "segment", "points", F.size("trajectory").alias("kept"))


# -- geometry and cells

_PROJECT = f"""SELECT event_id, 9 + k / 10.0 AS lon, 54 + least(value, 300) / 60.0 AS lat FROM pts), t AS (SELECT *, radians(lat) AS phi FROM ll),
r AS (SELECT *, {geo.AF!r} * pow(tan(pi() / 4 - phi / 2) / pow((1 - {geo._E!r} * sin(phi)) / (1 + {geo._E!r} * sin(phi)), {geo._E / 2!r}), {geo.N!r}) AS rho, {geo.N!r} * radians(lon - 10) AS theta FROM t)"""


@query(f"""WITH {PTS}, ll AS ({_PROJECT} SELECT event_id, round(4000000.0 + rho * sin(theta), 3) AS x, round({geo.FALSE_NORTH + geo.RHO0!r} - rho * cos(theta), 3) AS y FROM r""")
def project_lcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = geo.project(F.lit(9) + F.col("k") / 10, F.lit(54) + F.least(F.col("value"), F.lit(300)) / 60)
    return points(spark, sf_dir).select("event_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query(f"""WITH {PTS} SELECT event_id, round(9 + k / 10.0, 7) AS lon, round(54 + least(value, 300) / 60.0, 7) AS lat FROM pts""")
def unproject_lcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = geo.project(F.lit(9) + F.col("k") / 10, F.lit(54) + F.least(F.col("value"), F.lit(300)) / 60)
    p = points(spark, sf_dir).select("event_id", x.alias("x"), y.alias("y"))
    lon, lat = geo.unproject(F.col("x"), F.col("y"))
    return p.select("event_id", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


@query(f"""WITH {PTS} SELECT event_id, CAST(floor(x / 5000) AS BIGINT) AS x5000, CAST(floor(y / 5000) AS BIGINT) AS y5000, CAST(floor(x / 1000) AS BIGINT) AS x1000, CAST(floor(x / 200) AS BIGINT) AS x200, CAST(floor(x / 50) AS BIGINT) AS x50,
CAST(floor(x / 50) AS BIGINT) // 100 AS parent FROM pts""")
def cell_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    return points(spark, sf_dir).select("event_id", cells.cell_of(x, 5000).alias("x5000"), cells.cell_of(y, 5000).alias("y5000"), *[cells.cell_of(x, s).alias(f"x{s}") for s in (1000, 200, 50)], cells.parent_of(cells.cell_of(x, 50), 50, 5000).alias("parent"))


@query(f"""WITH {PTS} SELECT DISTINCT CAST(floor(x / 1000) AS BIGINT) AS cell_x, CAST(floor(y / 1000) AS BIGINT) AS cell_y, CAST(floor(x / 1000) AS BIGINT) // 5 AS parent_5000_x, CAST(floor(y / 1000) AS BIGINT) // 5 AS parent_5000_y FROM pts""")
def parent_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.used_cells(points(spark, sf_dir).select(cells.cell_of(F.col("x"), 1000).alias("cell_x"), cells.cell_of(F.col("y"), 1000).alias("cell_y")), 1000)


_PIECES = f"""{SEG}, legs AS (SELECT user_id, segment, infer_stopped, ts, x AS qx, y AS qy, epoch_us(ts) / 1e6 AS qt, lag(x) OVER w AS px, lag(y) OVER w AS py, lag(epoch_us(ts) / 1e6) OVER w AS pt, row_number() OVER w - 2 AS leg
  FROM seg WINDOW w AS (PARTITION BY user_id, segment ORDER BY ts, x, y)),
xs AS (SELECT *, CAST(floor(least(px, qx) / 5000) AS BIGINT) + 1 AS x1, CAST(ceil(greatest(px, qx) / 5000) AS BIGINT) - 1 AS x2, CAST(floor(least(py, qy) / 5000) AS BIGINT) + 1 AS y1, CAST(ceil(greatest(py, qy) / 5000) AS BIGINT) - 1 AS y2 FROM legs WHERE leg >= 0),
us AS (SELECT *, list_sort(list_distinct(list_concat([0.0::DOUBLE, 1.0::DOUBLE], list_concat(
  CASE WHEN px = qx OR x1 > x2 THEN []::DOUBLE[] ELSE list_transform(range(x1, x2 + 1), lambda i: (i * 5000 - px) / (qx - px)) END,
  CASE WHEN py = qy OR y1 > y2 THEN []::DOUBLE[] ELSE list_transform(range(y1, y2 + 1), lambda i: (i * 5000 - py) / (qy - py)) END)))) AS u FROM xs),
e AS (SELECT *, unnest(u) AS v, generate_subscripts(u, 1) AS part FROM us), p0 AS (SELECT *, lag(v) OVER (PARTITION BY user_id, segment, leg ORDER BY part) AS w FROM e),
pieces AS (SELECT *, CAST(floor((px + (w + v) / 2 * (qx - px)) / 5000) AS BIGINT) AS cell_x, CAST(floor((py + (w + v) / 2 * (qy - py)) / 5000) AS BIGINT) AS cell_y,
  (v - w) * sqrt((qx - px) ** 2 + (qy - py) ** 2) AS metres FROM p0 WHERE w IS NOT NULL)"""


@query(f"""WITH {_PIECES}, c AS (SELECT *, CASE WHEN cell_x = lag(cell_x) OVER o AND cell_y = lag(cell_y) OVER o THEN 0 ELSE 1 END AS enters FROM pieces WINDOW o AS (PARTITION BY user_id, segment ORDER BY leg, part)),
i AS (SELECT *, CAST(sum(enters) OVER (PARTITION BY user_id, segment ORDER BY leg, part ROWS UNBOUNDED PRECEDING) AS BIGINT) AS crossing FROM c)
SELECT user_id, segment, crossing, cell_x, cell_y, round(sum(metres), 3) AS metres FROM i GROUP BY ALL""")
def cell_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.crossings(arrays(spark, sf_dir), 5000, ("user_id", "segment")).select("user_id", "segment", "crossing", "cell_x", "cell_y", F.round("metres", 3).alias("metres"))


_DIRECTION = lambda e: f"""CASE least(y{e} - cell_y * 5000, (cell_y + 1) * 5000 - y{e}, (cell_x + 1) * 5000 - x{e}, x{e} - cell_x * 5000, 0.2)
  WHEN 0.2 THEN 4 WHEN y{e} - cell_y * 5000 THEN 1 WHEN (cell_y + 1) * 5000 - y{e} THEN 0 WHEN (cell_x + 1) * 5000 - x{e} THEN 2 ELSE 3 END"""  # noqa: E731
_TURNS = lambda c: f"coalesce(list_sum(list_transform(range(1, len({c})), lambda j: least({c}[j + 1] - {c}[j] - floor(({c}[j + 1] - {c}[j]) / 360) * 360, {c}[j] - {c}[j + 1] - floor(({c}[j] - {c}[j + 1]) / 360) * 360))), 0.0)"
#: Cell facts of the segments, from the cut pieces to the look-ups in the step functions.
_CELLS = f"""WITH {_PIECES}, c AS (SELECT *, CASE WHEN cell_x = lag(cell_x) OVER o AND cell_y = lag(cell_y) OVER o THEN 0 ELSE 1 END AS enters, px + w * (qx - px) AS ax, py + w * (qy - py) AS ay, pt + w * (qt - pt) AS at_,
  CASE WHEN v = 1 THEN qx ELSE px + v * (qx - px) END AS bx, CASE WHEN v = 1 THEN qy ELSE py + v * (qy - py) END AS by_, CASE WHEN v = 1 THEN qt ELSE pt + v * (qt - pt) END AS bt, leg * 1000000 + part AS place FROM pieces WINDOW o AS (PARTITION BY user_id, segment ORDER BY leg, part)),
i AS (SELECT *, CAST(sum(enters) OVER (PARTITION BY user_id, segment ORDER BY place ROWS UNBOUNDED PRECEDING) AS BIGINT) AS crossing, round(bx - ax, 6) AS dx, round(by_ - ay, 6) AS dy FROM c),
f AS (SELECT user_id, segment, crossing, cell_x, cell_y, round(arg_min(ax, place), 3) AS x0, round(arg_min(ay, place), 3) AS y0, floor(arg_min(at_, place)) AS t0, round(arg_max(bx, place), 3) AS x1, round(arg_max(by_, place), 3) AS y1, floor(arg_max(bt, place)) AS t1,
  sum(metres) AS metres, list_sort(list_distinct(list(round(COURSE, 6)) FILTER (WHERE dx <> 0 OR dy <> 0))) AS courses FROM i GROUP BY ALL),
steps AS (SELECT user_id, segment, epoch_us(ts) / 1e6 AS t, CAST(k AS DOUBLE) AS k, value FROM seg),
b AS (SELECT user_id, segment, crossing, max(t) AS since FROM f JOIN steps USING (user_id, segment) WHERE t <= t0 GROUP BY ALL),
h AS (SELECT user_id, segment, crossing, count(*) AS n, list_sort(list_distinct(list(k) FILTER (WHERE k IS NOT NULL))) AS ks, min(value) AS draught FROM f LEFT JOIN b USING (user_id, segment, crossing) JOIN steps USING (user_id, segment) WHERE t <= t1 AND t >= coalesce(since, t0) GROUP BY ALL),
cells AS (SELECT user_id, segment, crossing, cell_x, cell_y, CAST(({_DIRECTION(0)}) * 5 + ({_DIRECTION(1)}) + 1 AS INTEGER) AS direction_id, round(metres / greatest(t1 - t0, 1) * 1.94, 4) AS sog,
  round(CASE WHEN n > 0 THEN {_TURNS("ks")} ELSE -1.0 END, 4) AS delta_heading, draught, round({_TURNS("courses")}, 3) AS delta_cog, make_timestamp(CAST(t0 * 1000000 AS BIGINT)) AS tmin, make_timestamp(CAST(t1 * 1000000 AS BIGINT)) AS tmax FROM f LEFT JOIN h USING (user_id, segment, crossing)),
dated AS (SELECT *, CAST(strftime(tmin, '%Y%m%d') AS INTEGER) AS entry_date_id, CAST(strftime(tmin, '%H%M%S') AS INTEGER) AS entry_time_id FROM cells)""".replace("COURSE", "CASE WHEN degrees(atan2(dx, dy)) < 0 THEN degrees(atan2(dx, dy)) + 360 ELSE degrees(atan2(dx, dy)) END")


@query(f"{_CELLS} SELECT user_id, segment, crossing, cell_x, cell_y, direction_id, sog, delta_heading, draught, delta_cog, entry_date_id, entry_time_id FROM dated")
def cell_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole cell fact."""
    f = cells.fact_cell(arrays(spark, sf_dir), 5000, ("user_id", "segment"), ("infer_stopped",))
    return f.select("user_id", "segment", "crossing", "cell_x", "cell_y", "direction_id", F.round("sog", 4).alias("sog"), F.round("delta_heading", 4).alias("delta_heading"), "draught", F.round("delta_cog", 3).alias("delta_cog"), "entry_date_id", "entry_time_id")


@query(f"""{_CELLS} SELECT user_id, segment, crossing, cell_x, cell_y, entry_date_id FROM dated WHERE entry_date_id BETWEEN 20240105 AND 20240115 AND tmax >= TIMESTAMP '2024-01-05' AND tmin <= TIMESTAMP '2024-01-15'
AND cell_x * 5000 <= 60000 AND (cell_x + 1) * 5000 >= 10000 AND cell_y * 5000 <= 60000 AND (cell_y + 1) * 5000 >= 10000""")
def lazy_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells cut at query time."""
    t = arrays(spark, sf_dir)
    get = lambda c: F.transform("trajectory", lambda p: p[c])
    t = t.withColumns({"xmin": F.array_min(get("x")), "xmax": F.array_max(get("x")), "ymin": F.array_min(get("y")), "ymax": F.array_max(get("y")), "tmin": F.array_min(get("t")), "tmax": F.array_max(get("t")), "ship_id": F.col("user_id"), "nav_status_id": F.lit(0)})
    return analytic.lazy_cells(t, 5000, ("user_id", "segment"), analytic.Window(10000, 10000, 60000, 60000, 20240105, 20240115)).select("user_id", "segment", "crossing", "cell_x", "cell_y", "entry_date_id")


# -- star schema queries


@query(f"""WITH {PTS} SELECT c_custkey, c_name FROM customer c WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') AND EXISTS (SELECT 1 FROM pts p WHERE p.user_id = c.c_custkey
AND (floor(x / 5000) + 1) * 5000 >= 20000 AND floor(x / 5000) * 5000 <= 60000 AND (floor(y / 5000) + 1) * 5000 >= 10000 AND floor(y / 5000) * 5000 <= 70000 AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20')""")
def cell_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = (cells.cell_of(F.col(c), 5000) * 5000 for c in "xy")
    facts = points(spark, sf_dir).select(F.col("user_id").alias("ship_id"), keys.date_key(F.col("ts")).alias("entry_date_id"), x.alias("xmin"), y.alias("ymin"), (x + 5000).alias("xmax"), (y + 5000).alias("ymax"), F.col("ts").alias("tmin"), F.col("ts").alias("tmax"))
    ships = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ship_id"), "c_name", F.col("c_mktsegment").alias("ship_type_id"))
    types = ships.select("ship_type_id").distinct().withColumn("ship_type", F.col("ship_type_id"))
    found = analytic.cell_query(facts, ships, types, analytic.Window(20000, 10000, 60000, 70000, 20240105, 20240120), ["BUILDING", "MACHINERY", "AUTOMOBILE"])
    return found.select(F.col("ship_id").alias("c_custkey"), "c_name")


@query(f"""WITH {SEG}, legs AS (SELECT user_id, x AS qx, y AS qy, ts AS qt, lag(x) OVER w AS px, lag(y) OVER w AS py, lag(ts) OVER w AS pt FROM seg WINDOW w AS (PARTITION BY user_id, segment ORDER BY ts, x, y)),
c AS (SELECT *, qx - px AS dx, qy - py AS dy, epoch_us(pt) / 1e6 AS p, epoch_us(qt) / 1e6 AS q FROM legs WHERE px IS NOT NULL),
s AS (SELECT *, CASE WHEN dx = 0 THEN CASE WHEN px BETWEEN 20000 AND 30000 THEN 0.0 ELSE 2.0 END ELSE least((20000 - px) / dx, (30000 - px) / dx) END AS x0, CASE WHEN dx = 0 THEN 1.0 ELSE greatest((20000 - px) / dx, (30000 - px) / dx) END AS x1,
  CASE WHEN dy = 0 THEN CASE WHEN py BETWEEN 20000 AND 30000 THEN 0.0 ELSE 2.0 END ELSE least((20000 - py) / dy, (30000 - py) / dy) END AS y0, CASE WHEN dy = 0 THEN 1.0 ELSE greatest((20000 - py) / dy, (30000 - py) / dy) END AS y1 FROM c),
i AS (SELECT *, greatest(x0, y0, 0.0) AS a, least(x1, y1, 1.0) AS b FROM s)
SELECT DISTINCT c_custkey FROM i JOIN customer ON c_custkey = user_id WHERE a <= b AND p + b * (q - p) >= epoch_us(TIMESTAMP '2024-01-05') / 1e6 AND p + a * (q - p) < epoch_us(TIMESTAMP '2024-01-20') / 1e6""")
def trajectory_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = analytic.Window(20000, 20000, 30000, 30000, 20240105, 20240120)
    at = lambda k: F.to_timestamp(F.lit(str(k)), "yyyyMMdd")
    hits = arrays(spark, sf_dir).where(analytic.crosses_box(F.col("trajectory"), w, at(w.start_id), at(w.end_id))).select(F.col("user_id").alias("c_custkey"))
    return read(spark, sf_dir, "customer").join(hits, "c_custkey", "left_semi").select("c_custkey")


@query("""SELECT r_name, c_mktsegment, p_brand, CAST(count(*) AS BIGINT) AS lines, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(100 - round(l_discount * 100) AS BIGINT)) AS BIGINT) AS revenue FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def star_join_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: read(spark, sf_dir, n)
    j = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    j = j.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    return j.groupBy("r_name", "c_mktsegment", "p_brand").agg(F.count("*").alias("lines"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("long") * (100 - F.round(F.col("l_discount") * 100)).cast("long")).alias("revenue"))


@query("""SELECT CAST(count(*) AS BIGINT) AS rows, CAST(sum(entry_o_custkey % 1000) AS BIGINT) AS customers, CAST(count(DISTINCT part_p_brand) AS BIGINT) AS brands FROM
(SELECT o_custkey AS entry_o_custkey, p_brand AS part_p_brand FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)""")
def role_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = analytic.star(read(spark, sf_dir, "lineitem"), {"entry": (read(spark, sf_dir, "orders"), "o_orderkey", "l_orderkey"), "part": (read(spark, sf_dir, "part"), "p_partkey", "l_partkey")})
    return s.agg(F.count("*").alias("rows"), F.sum(F.col("entry_o_custkey") % 1000).alias("customers"), F.count_distinct("part_p_brand").alias("brands"))


# -- heatmaps


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points as cell facts: an hour per point, two ship types, partitions of two tiles."""
    x, y = (cells.cell_of(F.col(c), 1000) for c in "xy")
    return points(spark, sf_dir).select(
        x.alias("cell_x"), y.alias("cell_y"), keys.date_key(F.col("ts")).alias("entry_date_id"), keys.time_key(F.col("ts")).alias("entry_time_id"), (F.col("user_id") % 2).cast("int").alias("ship_type_id"), (F.col("value") < SLOW).alias("infer_stopped"),
        F.floor(F.col("x") / 10000).cast("int").alias("partition_id"), F.col("ts").alias("tmin"), (F.col("ts") + F.expr("make_interval(0, 0, 0, 0, 0, k, 0)")).alias("tmax"),
        F.col("k").cast("double").alias("delta_cog"), (F.col("k") - 50).cast("double").alias("delta_heading"), F.floor("value").cast("double").alias("draught"),
    )


_FACTS = f"""{PTS}, facts AS (SELECT CAST(floor(x / 1000) AS BIGINT) AS cell_x, CAST(floor(y / 1000) AS BIGINT) AS cell_y, CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS date_id, CAST(hour(ts) AS INTEGER) AS hour,
  CAST(user_id % 2 AS INTEGER) AS ship_type_id, value < {SLOW} AS infer_stopped, CAST(floor(x / 10000) AS INTEGER) AS partition_id, k, floor(value) AS draught FROM pts)"""


def _heat(slug: str) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        h = heatmap.preaggregate(_facts(spark, sf_dir), 1000).where(F.col("heatmap_type_id") == heatmap.ID[slug])
        return h.select("pixel_x", "pixel_y", "cell_x", "cell_y", "date_id", "time_id", "ship_type_id", "infer_stopped", "partition_id", F.round("band1", 3).alias("band1"), "band2")

    run.__name__ = f"heatmap_{slug}"
    return run


_BANDS = {"count": ("CAST(count(*) AS DOUBLE)", "CAST(NULL AS DOUBLE)"), "delta_cog": ("nullif(CAST(sum(k) AS DOUBLE), 0)", "CAST(count(*) AS DOUBLE)"), "delta_heading": ("nullif(CAST(sum(k - 50) AS DOUBLE), 0)", "CAST(count(*) AS DOUBLE)"), "max_draught": ("max(draught)", "CAST(NULL AS DOUBLE)"), "time": ("CAST(sum(k) * 60 AS DOUBLE)", "CAST(NULL AS DOUBLE)")}
for _slug, (_one, _two) in _BANDS.items():
    query(f"""WITH {_FACTS} SELECT cell_x AS pixel_x, cell_y AS pixel_y, cell_x // 5 AS cell_x, cell_y // 5 AS cell_y, date_id, CAST(hour * 10000 AS INTEGER) AS time_id, ship_type_id, infer_stopped, partition_id, {_one} AS band1, {_two} AS band2
    FROM facts GROUP BY facts.cell_x, facts.cell_y, date_id, hour, ship_type_id, infer_stopped, partition_id""")(_heat(_slug))

_BOXED = "date_id BETWEEN 20240103 AND 20240125 AND cell_x // 5 >= 1 AND cell_x // 5 < 12 AND cell_y // 5 >= 0 AND cell_y // 5 < 15"


def _window() -> analytic.Window:
    return analytic.Window(5000, 0, 60000, 75000, 20240103, 20240125)


def _types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(0, "Cargo", "Class A"), (1, "Pleasure", "Class A")], "ship_type_id int, ship_type string, mobile_type string")


@query(f"""WITH {_FACTS} SELECT partition_id, cell_x AS pixel_x, cell_y AS pixel_y, round(CAST(nullif(sum(k), 0) AS DOUBLE) / count(*), 6) AS value FROM facts WHERE {_BOXED} AND ship_type_id = 0 GROUP BY 1, 2, 3 HAVING sum(k) <> 0""")
def heatmap_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = heatmap.preaggregate(_facts(spark, sf_dir), 1000)
    return analytic.heatmap_query(h, _types(spark), "delta_cog", 1000, _window(), ["Cargo"], ["Class A"]).withColumn("value", F.round("value", 6))


@query(f"""WITH {_FACTS}, a AS (SELECT partition_id, cell_x, cell_y, count(*) AS v FROM facts WHERE {_BOXED} AND ship_type_id = 0 GROUP BY 1, 2, 3), b AS (SELECT partition_id, cell_x, cell_y, count(*) AS v FROM facts WHERE {_BOXED} AND ship_type_id = 1 GROUP BY 1, 2, 3),
ea AS (SELECT partition_id, min(cell_x) AS x0, max(cell_x) AS x1, min(cell_y) AS y0, max(cell_y) AS y1 FROM a GROUP BY 1), eb AS (SELECT partition_id, min(cell_x) AS x0, max(cell_x) AS x1, min(cell_y) AS y0, max(cell_y) AS y1 FROM b GROUP BY 1),
j AS (SELECT coalesce(a.partition_id, b.partition_id) AS partition_id, coalesce(a.cell_x, b.cell_x) AS pixel_x, coalesce(a.cell_y, b.cell_y) AS pixel_y, a.v AS va, b.v AS vb FROM a FULL JOIN b ON a.partition_id = b.partition_id AND a.cell_x = b.cell_x AND a.cell_y = b.cell_y)
SELECT j.partition_id, pixel_x, pixel_y, CAST(CASE WHEN va IS NULL THEN vb WHEN vb IS NULL THEN -va ELSE va - vb END AS INTEGER) AS value FROM j JOIN ea ON ea.partition_id = j.partition_id JOIN eb ON eb.partition_id = j.partition_id
WHERE pixel_x BETWEEN greatest(ea.x0, eb.x0) AND least(ea.x1, eb.x1) AND pixel_y BETWEEN greatest(ea.y0, eb.y0) AND least(ea.y1, eb.y1)""")
def heatmap_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = heatmap.preaggregate(_facts(spark, sf_dir), 1000)
    return analytic.heatmap_difference(h, _types(spark), "count", 1000, _window(), ["Cargo"], ["Pleasure"], ["Class A"])


# -- dimensions


@query("""SELECT CAST(c_nationkey AS INTEGER) AS ship_id, c_mktsegment AS ship_type FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE c_nationkey = -1)
UNION ALL SELECT CAST(row_number() OVER (ORDER BY c_nationkey, c_mktsegment) + (SELECT max(n_nationkey) FROM nation) AS INTEGER), c_mktsegment FROM
(SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE NOT (c_nationkey < 5 AND c_mktsegment = 'BUILDING'))
UNION ALL SELECT CAST(n_nationkey AS INTEGER), 'BUILDING' FROM nation WHERE n_nationkey < 5 UNION ALL SELECT CAST(n_nationkey AS INTEGER), NULL FROM nation WHERE n_nationkey >= 5""")
def get_or_create_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ship_id"), F.col("n_nationkey").alias("nation"), F.when(F.col("n_nationkey") < 5, "BUILDING").alias("ship_type"))
    batch = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("ship_type"))
    return dims.get_or_create(old, batch, ("nation", "ship_type"), "ship_id").select("ship_id", "ship_type")


@query("""SELECT c_custkey, CAST(n_nationkey AS INTEGER) AS nation_id FROM customer LEFT JOIN nation ON nullif(c_nationkey, 3) IS NOT DISTINCT FROM nullif(n_nationkey, 3)""")
def attach_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select("c_custkey", F.nullif(F.col("c_nationkey"), F.lit(3)).alias("k"))
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation_id"), F.nullif(F.col("n_nationkey"), F.lit(3)).alias("k"))
    return dims.attach_key(c, n, ("k",), "nation_id").select("c_custkey", "nation_id")


_EASTER = """e0 AS (SELECT y, 225 - 11 * (y % 19) AS d FROM years), e1 AS (SELECT y, d - greatest(0, CAST(floor((d - 21) / 30.0) AS INTEGER)) * 30 AS d FROM e0), e2 AS (SELECT y, CASE WHEN d > 48 THEN d - 1 ELSE d END AS d FROM e1),
e3 AS (SELECT y, d + 7 - (y + y // 4 + d + 1) % 7 AS q FROM e2), e4 AS (SELECT y, CASE WHEN q < 32 THEN 3 ELSE 4 END AS m, CASE WHEN q < 32 THEN q ELSE q - 31 END AS d FROM e3),
e5 AS (SELECT y, m, d + o AS x FROM e4, (SELECT unnest([0, 1, -2, -3, -7, 40]) AS o)), easter AS (SELECT y AS year, CAST(CASE WHEN x > 31 THEN m + (x - 1) // 31 WHEN x < 1 THEN m - 1 ELSE m END AS INTEGER) AS month,
  CAST(CASE WHEN x > 31 THEN x - (x - 1) // 31 * 31 WHEN x < 1 THEN x + 31 ELSE x END AS INTEGER) AS day FROM e5)"""


@query(f"WITH years AS (SELECT CAST(range AS INTEGER) AS y FROM range(1900, 2100)), {_EASTER} SELECT CAST(year AS INTEGER) AS year, month, day FROM easter")
def easter_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = spark.range(1900, 2100).select(F.col("id").cast("int").alias("year"))
    return y.select("year", F.explode(calendar.easter_holidays(F.col("year"))).alias("md")).select("year", F.floor(F.col("md") / 100).cast("int").alias("month"), (F.col("md") % 100).cast("int").alias("day"))


_DATES = """SELECT CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_id, CAST(date AS VARCHAR) AS date, CAST(dayofweek(date) AS INTEGER) AS day_of_week, CAST(day(date) AS INTEGER) AS day_of_month, CAST(dayofyear(date) AS INTEGER) AS day_of_year, CAST(week(date) AS INTEGER) AS week_of_year,
CAST(month(date) AS INTEGER) AS month_of_year, CAST(quarter(date) AS INTEGER) AS quarter_of_year, CAST(year(date) AS INTEGER) AS year, CAST(isoyear(date) AS INTEGER) AS iso_year, lower(dayname(date)) AS day_name, lower(monthname(date)) AS month_name,
CASE WHEN dayofweek(date) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS weekday, CASE WHEN month(date) IN (12, 1, 2) THEN 'winter' WHEN month(date) <= 5 THEN 'spring' WHEN month(date) <= 8 THEN 'summer' ELSE 'autumn' END AS season,
CASE WHEN EXISTS (SELECT 1 FROM (SELECT year, month, day FROM easter UNION SELECT y, m, d FROM years, (VALUES (1, 1), (5, 15), (5, 16), (6, 5), (12, 24), (12, 25), (12, 26), (12, 31)) f(m, d)) h WHERE h.year = year(date) AND h.month = month(date) AND h.day = day(date)) THEN 'holiday' ELSE 'non-holiday' END AS holiday"""


@query(f"WITH years AS (SELECT CAST(range AS INTEGER) AS y FROM range(2019, 2026)), {_EASTER}, dates AS (SELECT CAST(range AS DATE) AS date FROM range(DATE '2019-01-01', DATE '2026-01-01', INTERVAL 1 DAY)) {_DATES} FROM dates")
def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.date_attributes(dims.date_range(spark, "2019-01-01", "2025-12-31")).withColumn("date", F.col("date").cast("string"))


@query(f"""WITH years AS (SELECT DISTINCT CAST(year(d) AS INTEGER) AS y FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem UNION SELECT CAST(o_orderdate AS DATE) FROM orders)), {_EASTER},
dates AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem UNION SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders) SELECT date_id, day_name, holiday FROM ({_DATES} FROM dates)""")
def stacked_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read(spark, sf_dir, "lineitem").select(keys.date_key(F.col("l_shipdate")).alias("a"), F.lit(-1).alias("b"))
    b = read(spark, sf_dir, "orders").select(F.lit(-1).alias("a"), keys.date_key(F.col("o_orderdate")).alias("b"))
    return dims.date_attributes(dims.distinct_dates(a.unionByName(b), ("a", "b"))).select("date_id", "day_name", "holiday")


@query("""SELECT CAST(s // 3600 * 10000 + s // 60 % 60 * 100 + s % 60 AS INTEGER) AS time_id, lpad(CAST(s // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') AS time,
CAST(s // 3600 AS INTEGER) AS hour_of_day, CAST(s // 60 % 60 AS INTEGER) AS minute_of_hour, CAST(s % 60 AS INTEGER) AS second_of_minute FROM (SELECT range AS s FROM range(86400)) UNION ALL SELECT -1, NULL, -1, -1, -1""")
def time_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_time(spark)


@query("""WITH d AS (SELECT unnest(['North', 'South', 'East', 'West', 'Unknown']) AS n, generate_subscripts(['North', 'South', 'East', 'West', 'Unknown'], 1) AS i)
SELECT CAST((a.i - 1) * 5 + b.i AS INTEGER) AS direction_id, a.n AS "from", b.n AS "to" FROM d a, d b""")
def direction_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_direction(spark)


# -- partitions, warehouse

_BOXES = ((0, 0, 30000, 30000), (30000, 0, 60000, 30000), (0, 30000, 60000, 60000), (60000, 0, 330000, 100000))


@query(f"""WITH {PTS}, t AS (SELECT event_id, floor(x / 5000) * 5000 AS xmin, floor(y / 5000) * 5000 AS ymin FROM pts), p AS (SELECT * FROM (VALUES {", ".join(f"({i}, {a}, {b}, {c}, {d})" for i, (a, b, c, d) in enumerate(_BOXES, 1))}) v(partition_id, x0, y0, x1, y1))
SELECT event_id, CAST(partition_id AS INTEGER) AS partition_id FROM t JOIN p ON xmin >= x0 AND xmin + 5000 <= x1 AND ymin >= y0 AND ymin + 5000 <= y1 AND y1 <> ymin AND x1 <> xmin""")
def range_join_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.createDataFrame([(i, *map(float, b)) for i, b in enumerate(_BOXES, 1)], "partition_id int, xmin double, ymin double, xmax double, ymax double")
    x, y = (cells.cell_of(F.col(c), 5000) * 5000 for c in "xy")
    t = points(spark, sf_dir).select("event_id", x.alias("xmin"), y.alias("ymin"), (x + 5000).alias("xmax"), (y + 5000).alias("ymax"))
    return partition.assign_partition(t, p).select("event_id", "partition_id")


@query(f"WITH {PTS} SELECT CAST(floor(x / 5000) AS BIGINT) AS cell_x, CAST(floor(y / 5000) AS BIGINT) AS cell_y, CAST(count(*) AS BIGINT) AS points, CAST(sum(CASE WHEN x < 40000 THEN k ELSE 0 END) AS BIGINT) AS west FROM pts GROUP BY 1, 2")
def kd_tree_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = points(spark, sf_dir)
    return p.groupBy(cells.cell_of(F.col("x"), 5000).alias("cell_x"), cells.cell_of(F.col("y"), 5000).alias("cell_y")).agg(F.count("*").alias("points"), F.coalesce(F.sum(F.when(F.col("x") < 40000, F.col("k")).otherwise(0)), F.lit(0)).alias("west"))


@query()
def kd_tree_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy splitting is iterative: no SQL."""
    p = points(spark, sf_dir).select(cells.cell_of(F.col("x"), 5000).alias("cell_x"), cells.cell_of(F.col("y"), 5000).alias("cell_y"))
    return partition.build_partitions(p, 16, (0, 0, 400000, 100000))


@query("SELECT event_id FROM events WHERE CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) NOT IN (20240103, 20240104, 20240105)")
def rollback_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("date_id", keys.date_key(F.col("ts")))
    return without_days(e, "date_id", [20240103, 20240104, 20240105]).select("event_id")


@query("""SELECT l_orderkey, min(l_linenumber) AS l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_orderkey""")
def dedup_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return insert_new(old, read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), ("l_orderkey",))


@query("""SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS trajectory_sub_id FROM customer""")
def unique_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surrogate numbers without one task for all rows: counts of key ranges first, then ranks within each."""
    c = read(spark, sf_dir, "customer").select("c_custkey", F.floor(F.col("c_custkey") / 1000).alias("block"))
    base = c.groupBy("block").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    return c.join(base.select("block", "base"), "block").select("c_custkey", (F.row_number().over(W.partitionBy("block").orderBy("c_custkey")) + F.col("base")).cast("long").alias("trajectory_sub_id"))


@query(f"""WITH {PTS}, g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) < {GAP * 1000000} THEN 0 ELSE 1 END AS b FROM pts WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM g)
SELECT user_id, CAST(epoch_us(min(ts)) AS BIGINT) AS session_start, CAST(epoch_us(max(ts)) AS BIGINT) AS session_last, CAST(count(*) AS BIGINT) AS points, round(avg(value), 6) AS mean_value FROM s GROUP BY user_id, s""")
def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sessions(points(spark, sf_dir), "user_id", "ts", "value", GAP)
    return s.select("user_id", F.unix_micros("session_start").alias("session_start"), F.unix_micros("session_last").alias("session_last"), "points", F.round("mean_value", 6).alias("mean_value"))


