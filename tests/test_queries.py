from __future__ import annotations

import pytest

from fathomline.plans import proxies


@pytest.mark.parametrize("name", sorted(proxies.SQL))
def test_query_matches_sql(name, spark, sf, matches_sql):
    matches_sql(proxies.QUERIES[name](spark, sf), proxies.SQL[name])


@pytest.mark.parametrize("name", sorted(set(proxies.QUERIES) - set(proxies.SQL)))
def test_query_without_sql_gives_rows(name, spark, sf):
    assert proxies.QUERIES[name](spark, sf).count() > 0


def test_kd_tree_leaves_hold_what_lies_in_them(spark, sf):
    leaves = proxies.kd_tree_leaves(spark, sf).collect()
    tiles = [(int(r.x // 5000), int(r.y // 5000)) for r in proxies.points(spark, sf).select("x", "y").collect()]
    inside = [(x, y) for x, y in tiles if 0 <= x < 80 and 0 <= y < 20]
    holds = lambda q, x, y: q.xmin <= x * 5000 < q.xmax and q.ymin <= y * 5000 < q.ymax
    assert len(leaves) == 16 and all(q.points == sum(holds(q, x, y) for x, y in inside) for q in leaves)
    assert all(sum(holds(q, x, y) for q in leaves) == 1 for x in range(80) for y in range(20))
    # The fullest are cut first.
    assert max(q.points for q in leaves if q.xmax - q.xmin > 5000 or q.ymax - q.ymin > 5000) <= len(inside) // 4


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())


def test_scan_prunes_and_pushes(spark, sf):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = proxies.clean_filter(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "LessThan(l_quantity,45.0)" in plan
    assert "l_extendedprice" not in plan


def test_cells_need_no_join_with_a_grid(spark, sf):
    plan = proxies.cell_crossings(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
