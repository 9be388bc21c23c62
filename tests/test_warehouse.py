from __future__ import annotations

import random
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fathomline.operators import dims, partition
from fathomline.plans import benchmark, load, queries, warehouse
from fathomline.sources import ais, config, ingest, sqlfiles
from fathomline.streaming import ingest as streaming
from tests.test_trajectory import lying, raw, sailing


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    w = load.Warehouse(spark, str(tmp_path_factory.mktemp("wh")))
    load.initialise(w, "2021-03-01", "2021-03-31")
    rows = sailing(0, 40) + lying(5000, 8, 120, lat=57.2)
    rows += [tuple(219000002 if i == 2 else v for i, v in enumerate(r)) for r in sailing(600, 30, lat=56.9)]
    for _ in range(2):  # a day that is loaded again is there once
        load.load_day(w, raw(spark, rows), sizes=(5000, 1000))
    return w


def test_load_twice_leaves_one_copy(loaded):
    assert loaded.read("fact_trajectory").count() == 3
    assert loaded.read("dim_ship").count() == 2 and loaded.read("dim_ship_type").count() == 1
    assert loaded.read("audit_log").count() == 2
    ids = [r[0] for r in loaded.read("dim_ship").select("ship_id").collect()]
    assert sorted(ids) == [1, 2]


def test_time_in_cells_is_the_same_at_each_size(loaded):
    seconds = lambda s: loaded.read(f"fact_cell_{s}m").agg(F.sum(F.unix_seconds("tmax") - F.unix_seconds("tmin"))).first()[0]
    assert abs(seconds(5000) - seconds(1000)) <= loaded.read("fact_cell_1000m").count()


def test_queries_over_the_warehouse(loaded):
    facts, ships, types = (loaded.read(n) for n in ("fact_cell_1000m", "dim_ship", "dim_ship_type"))
    box = facts.agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).first()
    w = queries.Window(*box, 20210304, 20210305)
    assert queries.cell_query(facts, ships, types, w, ["Passenger"]).count() == 2
    assert queries.cell_query(facts, ships, types, w, ["Cargo"]).count() == 0
    assert queries.cell_query(facts, ships, types, queries.Window(*box, 20210305, 20210306), ["Passenger"]).count() == 0
    assert queries.trajectory_query(loaded.read("dim_trajectory"), loaded.read("fact_trajectory"), ships, types, w, ["Passenger"]).count() == 2
    heat = loaded.read("fact_cell_heatmap_1000m")
    counts = queries.heatmap_query(heat, types, "count", 1000, queries.Window(3480000, 2930000, 4495000, 3645000, 20210304, 20210304), ["Passenger"], ["Class A"])
    assert counts.agg(F.sum("value")).first()[0] == facts.count()


def test_lazy_cells_equal_stored_ones(loaded):
    stored = loaded.read("fact_cell_1000m")
    one = stored.orderBy("xmin", "ymin").first()
    w = queries.Window(one.xmin, one.ymin, one.xmax + 9000, one.ymax + 9000, 20210304, 20210305)
    t = loaded.read("dim_trajectory").withColumnRenamed("date_id", "start_date_id").join(loaded.read("fact_trajectory").select("start_date_id", "trajectory_sub_id", "ship_id", "nav_status_id", "infer_stopped"), ["start_date_id", "trajectory_sub_id"])
    cols = ["trajectory_sub_id", "cell_x", "cell_y", "entry_time_id", "exit_time_id", "direction_id"]
    a = queries.lazy_cells(t, 1000, ("start_date_id", "trajectory_sub_id"), w).select(*cols).collect()
    b = queries.stored_cells(stored, w).select(*cols).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and a


def test_rollback(spark, tmp_path):
    df = spark.createDataFrame([(20210301, 1), (20210302, 2), (20210401, 3)], "date_id int, v int")
    warehouse.write_days(df, str(tmp_path / "t"), "date_id")
    gone = warehouse.rollback(spark, {"t": str(tmp_path / "t")}, 20210302, 20210331)
    assert len(gone) == 1 and sorted(r.v for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 3]
    assert [b[0] for b in warehouse.month_batches(20210225, 20210312)] == [20210225, 20210301, 20210311]
    with pytest.raises(ValueError, match="months"):
        warehouse.without_days(df, "date_id", [20210301, 20210401])


def test_get_or_create(spark):
    old = spark.createDataFrame([(7, "a", None)], "id long, x string, y int")
    new = spark.createDataFrame([("a", None), ("b", 1), ("b", 1), (None, None)], "x string, y int")
    out = dims.get_or_create(old, new, ("x", "y"), "id")
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(7, "a", None), (8, None, None), (9, "b", 1)], key=str)
    assert dims.attach_key(new, out, ("x", "y"), "id").where("id is null").count() == 0


def test_kd_tree(spark):
    rng = random.Random(1)
    counts = {(x, y): rng.randint(0, 50) for x in range(16) for y in range(16)}
    box = (0, 0, 80000, 80000)
    leaves = partition.kd_tree(counts, 20, box)
    assert len(leaves) == 20 and sum(x.points for x in leaves) == sum(counts.values())
    assert sum((x.xmax - x.xmin) * (x.ymax - x.ymin) for x in leaves) == 80000**2
    df = spark.createDataFrame([(i, x.xmin, x.ymin, x.xmax, x.ymax) for i, x in enumerate(leaves)], "partition_id int, xmin int, ymin int, xmax int, ymax int")
    cells = spark.createDataFrame([(x * 5000, y * 5000, x * 5000 + 5000, y * 5000 + 5000) for x, y in counts], "xmin int, ymin int, xmax int, ymax int")
    assert partition.assign_partition(cells, df).count() == 256  # each tile in one leaf
    assert len(partition.kd_tree({}, 3, (0, 0, 5000, 5000))) == 1


@pytest.mark.parametrize(("name", "day"), [("aisdk-2007-04.zip", date(2007, 4, 1)), ("aisdk-2007-04-03.zip", date(2007, 4, 3)), ("aisdk-2021-12-31.rar", date(2021, 12, 31))])
def test_date_from_filename(name, day):
    assert ingest.date_from_filename(name) == day


def test_ingest(tmp_path):
    with pytest.raises(ValueError, match="no date"):
        ingest.date_from_filename("readme.zip")
    page = b'<a href="aisdk-2021-03.zip">x</a><a href="aisdk-2021-03-04.csv">y</a><a href="/">z</a>'
    found = ingest.list_archives("http://host/ais/", lambda u: page)
    assert found == {date(2021, 3, 1): ingest.Archive("aisdk-2021-03.zip", "http://host/ais/aisdk-2021-03.zip")}
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("aisdk_20210304.csv", "h\n")
        z.writestr("../evil.csv", "h\n")
    path = ingest.ensure_day(date(2021, 3, 4), tmp_path, found, lambda u: (tmp_path / "a.zip").read_bytes())
    assert path.name == "aisdk-2021-03-04.csv" and path.exists() and not (tmp_path.parent / "evil.csv").exists()
    assert len(list(ingest.days(date(2021, 2, 27), date(2021, 3, 2)))) == 4


def test_reader(spark, tmp_path):
    with pytest.raises(NotImplementedError):
        ais.read_reports(spark, "x.xml")
    raw(spark, sailing(0, 5)).coalesce(1).write.option("header", True).csv(str(tmp_path / "csv"))
    df = ais.read_reports(spark, str(tmp_path / "csv"))
    assert df.count() == 5 and df.select(F.try_to_timestamp("timestamp_text", F.lit("dd/MM/yyyy HH:mm:ss")).alias("t")).first().t == datetime(2021, 3, 4, 10)
    path = ais.write_day_cache(df, str(tmp_path / "cache"), "2021-03-04")
    assert ais.read_day(spark, path, "none.csv")[1] and not ais.read_day(spark, str(tmp_path / "no"), str(tmp_path / "csv"))[1]
    (tmp_path / "aisdk-2021-03.csv").write_text("# Timestamp\n1\n")
    named = ais.with_file_date(spark.read.text(str(tmp_path / "aisdk-2021-03.csv")))
    assert named.first().file_date == date(2021, 3, 1)


def test_ascii_grid(spark):
    df = spark.createDataFrame([(1, 10, 5, 2.0), (1, 11, 6, 3.0)], "partition_id int, pixel_x long, pixel_y long, value double")
    text = ais.ascii_grid(df, 50).first().grid
    assert text.splitlines() == ["ncols 2", "nrows 2", "xllcorner 500", "yllcorner 250", "cellsize 50", "NODATA_value -9999", "-9999 3", "2 -9999"]


def test_sql_files(spark, tmp_path):
    assert sqlfiles.statements("select ';' -- a;b\n; /* c;d */ select 2;") == ["select ';' -- a;b", "/* c;d */ select 2"]
    (tmp_path / "1.sql").write_text("CREATE OR REPLACE TEMP VIEW v{N} AS SELECT :x AS x;")
    (tmp_path / "2.sql").write_text("SELECT x + :y AS z FROM v{N}")
    assert sqlfiles.run_folder(spark, tmp_path, names={"N": "9"}, args={"x": 3, "y": 4}) == ["1.sql", "2.sql"]
    assert sqlfiles.run_file(spark, tmp_path / "2.sql", names={"N": "9"}, args={"y": 4}).first().z == 7


def test_config(tmp_path):
    (tmp_path / "c.ini").write_text("[fathomline]\ncell_sizes = 5000, 50\ndrop_on_init = false\n")
    c = config.load_config(tmp_path / "c.ini", {"FATHOMLINE_PARTITIONS": "7"})
    assert c.cell_sizes == (5000, 50) and c.drop_on_init is False and c.partitions == 7
    with pytest.raises(ValueError, match="boolean"):
        config.load_config(None, {"FATHOMLINE_DROP_ON_INIT": "maybe"})


def test_audit_and_retry(spark):
    a = warehouse.Audit("1.2", ("pyspark",))
    with a.timed("x"):
        df, seen = a.observed(spark.range(5), "five")
        df.collect()
    a.counted("five", seen)
    a.file(10, 5)
    r = a.frame(spark).first()
    assert (r.version, r.requirements, r.file_size, r.counts) == ("1.2", ["pyspark"], 10, '{"five": 5}') and '"x"' in r.timings
    tries = []
    assert warehouse.retried(lambda: tries.append(1) or (len(tries) == 3 or 1 / 0)) is True and len(tries) == 3


def test_benchmark(spark, tmp_path):
    @benchmark.benchmark("tiny")
    class Tiny(benchmark.Benchmark):
        pass

    b = benchmark.REGISTRY["tiny"]({"ok": {"n": 3}, "bad": {"n": None}}, lambda n: spark.range(n), [lambda rng: spark.range(rng.randint(1, 3))])
    rows = b.run(2)
    assert [r["configuration"] for r in rows] == ["ok", "ok", "bad"] and rows[0]["ms"] > 0 and rows[2]["error"]
    benchmark.save(spark, rows, "tiny", str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).count() == 3


def test_streams(spark, tmp_path):
    for i, rows in enumerate((sailing(0, 5), sailing(3000, 4))):
        raw(spark, rows).coalesce(1).write.mode("append").option("header", True).csv(str(tmp_path / "in"))
        seen = []
        streaming.load_stream(streaming.report_stream(spark, str(tmp_path / "in")), lambda df, n, seen=seen: seen.append(df.count()), str(tmp_path / "cp")).awaitTermination()
        assert sum(seen) == (5, 4)[i]
    events = spark.createDataFrame([(1, datetime(2021, 1, 1, 0, m), 1.0) for m in (0, 5, 30)], "k int, ts timestamp, v double")
    assert sorted(r.points for r in streaming.sessions(events, "k", "ts", "v").collect()) == [1, 2]


def on(day: str, rows: list[tuple]) -> list[tuple]:
    """The same reports on another date (dd/mm/yyyy)."""
    return [(day + r[0][10:], *r[1:]) for r in rows]


def partition_filters(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return " ".join(line for line in plan.splitlines() if "PartitionFilters" in line)


def test_date_filters_prune_folders(loaded):
    facts, ships, types = (loaded.read(n) for n in ("fact_cell_1000m", "dim_ship", "dim_ship_type"))
    w = queries.Window(0, 0, 1e7, 1e7, 20210304, 20210305)
    heat = loaded.read("fact_cell_heatmap_1000m")
    for df, column in (
        (queries.cell_query(facts, ships, types, w, ["Passenger"]), "entry_date_id"), (queries.stored_cells(facts, w), "entry_date_id"),
        (queries.trajectory_query(loaded.read("dim_trajectory"), loaded.read("fact_trajectory"), ships, types, w, ["Passenger"]), "start_date_id"),
        (queries.heatmap_query(heat, types, "count", 1000, w, ["Passenger"], ["Class A"]), "date_id"),
    ):
        assert f"{column}#" in partition_filters(df).split("PartitionFilters: [", 1)[1], column


def test_large_days_are_dealt_to_several_tasks(spark, tmp_path):
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k"}
    kept = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(0, 200_000, 1, 8).select(F.lit(20210304).alias("date_id"), F.xxhash64("id").alias("v"), F.rand(1).alias("x"))
        warehouse.write_days(df, str(tmp_path / "t"), "date_id", ("x",))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 200_000 and back.select(F.input_file_name()).distinct().count() > 4


def test_a_stray_report_erases_nothing(spark, tmp_path):
    w = load.Warehouse(spark, str(tmp_path / "wh"))
    load.load_day(w, raw(spark, sailing(0, 40)), sizes=(5000,))
    before = w.read("fact_cell_5000m").count()
    stray = sailing(0, 30)[:1]  # a report of the day before in the next day's file
    load.load_day(w, raw(spark, on("05/03/2021", sailing(0, 40)) + stray), sizes=(5000,))
    counts = {r.entry_date_id: r["count"] for r in w.read("fact_cell_5000m").groupBy("entry_date_id").count().collect()}
    assert counts == {20210304: before, 20210305: before}
    cells = w.read("dim_cell_5000m")
    assert cells.count() == cells.distinct().count() == w.read("fact_cell_5000m").select("cell_x", "cell_y").distinct().count()


def test_files_of_one_day_are_merged(spark, tmp_path):
    w, whole = (load.Warehouse(spark, str(tmp_path / n)) for n in ("parts", "whole"))
    rows = sailing(0, 40)
    for batch, part in enumerate((rows[:20], rows[20:], rows[20:])):  # the last batch runs twice
        load.take_reports(w, raw(spark, part), min(batch, 1), sizes=(5000,))
    load.load_day(whole, raw(spark, rows), sizes=(5000,))
    facts = lambda x: sorted(map(tuple, x.read("fact_cell_5000m").select("trajectory_sub_id", "cell_x", "cell_y", "tmin", "tmax").collect()))
    assert facts(w) == facts(whole) and facts(w)


def test_a_day_without_plausible_reports(spark, tmp_path):
    w = load.Warehouse(spark, str(tmp_path / "wh"))
    load.load_day(w, raw(spark, sailing(0, 40)).where("false"), sizes=(5000,))
    load.load_day(w, raw(spark, sailing(0, 2)), sizes=(5000,))  # too few points for a segment
    assert w.read("audit_log").count() == 2 and not w.exists("fact_trajectory")


def test_flag_state_in_the_ship_dimension(spark, tmp_path):
    w = load.Warehouse(spark, str(tmp_path / "wh"))
    mids = spark.createDataFrame([(219, "Europe", "Denmark")], "mid int, flag_region string, flag_state string")
    load.load_day(w, raw(spark, sailing(0, 40)), sizes=(5000,), mids=mids)
    assert [tuple(r) for r in w.read("dim_ship").select("mid", "flag_region", "flag_state").collect()] == [(219, "Europe", "Denmark")]


def test_points_pass_once(spark):
    from fathomline.operators import trajectory
    from fathomline.operators.cells import fact_cell
    from fathomline.operators.clean import clean

    built = trajectory.build(clean(raw(spark, sailing(0, 40))))
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInPandas") == 1 and "Join" not in plan
    built = built.withColumns({"ship_id": F.lit(1), "nav_status_id": F.lit(1)})
    assert "Join" not in fact_cell(built, 1000, ("mmsi", "day"))._jdf.queryExecution().executedPlan().toString()


def test_command_line(spark, tmp_path, monkeypatch):
    from fathomline import __main__ as cli

    (tmp_path / "ais").mkdir()
    reports = raw(spark, sailing(0, 40)).coalesce(1).toPandas()
    text = reports.to_csv(index=False)
    with zipfile.ZipFile(tmp_path / "day.zip", "w") as z:
        z.writestr("aisdk-2021-03-04.csv", text)
    pages = {"http://host/": b'<a href="aisdk-2021-03-04.zip">x</a>', "http://host/aisdk-2021-03-04.zip": (tmp_path / "day.zip").read_bytes()}
    for name, value in {"AIS_PATH": tmp_path / "ais", "AIS_URL": "http://host/", "WAREHOUSE": tmp_path / "wh", "CELL_SIZES": "5000 50", "DROP_ON_INIT": "true"}.items():
        monkeypatch.setenv(f"FATHOMLINE_{name}", str(value))
    day = ["--from_date", "2021-03-04", "--to_date", "2021-03-04"]
    cli.main(["--ensure_files", *day], spark, pages.__getitem__)
    assert (tmp_path / "ais/aisdk-2021-03-04.csv").exists()
    cli.main(["--init"], spark)
    cli.main(["--clean_standalone", *day], spark, pages.__getitem__)
    (tmp_path / "ais/aisdk-2021-03-04.csv").unlink()  # from here on the kept trajectories serve
    cli.main(["--load", *day], spark, {}.__getitem__)
    w = load.Warehouse(spark, str(tmp_path / "wh"))
    assert w.read("fact_trajectory").count() == 1 and w.read("dim_date").count() > 20000 and w.read("audit_log").count() == 1
    with pytest.raises(SystemExit):
        cli.main(["--load"], spark)


def test_suites(loaded):
    from fathomline.plans import suites

    cell, heat, lazy = suites.CellSuite.over(loaded), suites.HeatmapSuite.over(loaded), suites.LazySuite.over(loaded, 1000)
    names = lambda s, p: [n for n in s.configurations if n.startswith(p)]
    assert (len(names(cell, "cell_")), len(names(cell, "trajectory_")), len(heat.configurations), len(lazy.configurations)) == (27, 12, 72, 12)
    assert set(benchmark.REGISTRY) >= {"CELL", "HEATMAP", "LAZY"}
    for suite, name in ((cell, "cell_1000m_1_day_large_area"), (cell, "trajectory_90_day_large_area"), (heat, "heatmap_1_year_low_resolution_complete"), (heat, "difference_1_day_very_low_resolution_aarhus"), (lazy, "lazy_1_day_near_heligoland"), (lazy, "stored_1_week_near_heligoland")):
        assert suite.query(**suite.configurations[name]).count() == 0  # the loaded day is in March, its ships carry passengers
    window, size = suites.random_window(random.Random(3))
    assert size in (50, 200, 1000, 5000) and window.start_id <= window.end_id and window.xmin < window.xmax
    suites.warm_up(loaded, (5000, 1000))(random.Random(1)).count()
