from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.sql.warehouse.dir", f"{base}/warehouse").config("spark.checkpoint.dir", f"file://{base}/shared").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def plain(v):
    if v is None or type(v).__name__ in ("NAType", "NaTType") or v != v:
        return None
    if isinstance(v, bool):
        return v
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        v = round(v, 5)
        return int(v) if v == int(v) else v
    return str(v) if not isinstance(v, int) else v


def as_rows(pdf) -> list[tuple]:
    cols = sorted(pdf.columns)
    return sorted((tuple(plain(x) for x in r) for r in pdf[cols].astype(object).itertuples(index=False)), key=repr)


@pytest.fixture(scope="session")
def duck(sf):
    import duckdb

    con = duckdb.connect()
    for f in Path(sf).glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.fixture
def matches_sql(duck):
    def check(df, sql: str) -> None:
        got, want = df.toPandas(), duck.sql(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        a, b = as_rows(got), as_rows(want)
        assert len(a) == len(b)
        assert a == b, next((x for x in zip(a, b, strict=True) if x[0] != x[1]), None)

    return check
