"""Command line: ``python -m fathomline --init``, ``--load --from_date 2021-03-01 --to_date 2021-03-31`` and so on."""

from __future__ import annotations

import argparse
import sys
from datetime import date
from pathlib import Path

from pyspark.sql import SparkSession

from fathomline.plans import load
from fathomline.plans.warehouse import Audit
from fathomline.sources import ais, ingest
from fathomline.sources.config import Config, load_config


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="fathomline", description="Load ship positions into a warehouse.")
    p.add_argument("--init", action="store_true", help="write the static dimensions")
    p.add_argument("--load", action="store_true", help="load the days of the range into the warehouse")
    p.add_argument("--clean_standalone", action="store_true", help="build the trajectories of the days and keep them as Parquet")
    p.add_argument("--ensure_files", action="store_true", help="download what is missing of the days' files")
    p.add_argument("--from_date", type=date.fromisoformat, help="the first day, YYYY-MM-DD")
    p.add_argument("--to_date", type=date.fromisoformat, help="the last day, YYYY-MM-DD")
    p.add_argument("--config", help="an INI file; settings from the environment come first")
    return p


def initialise(spark: SparkSession, config: Config) -> None:
    """Static dimensions; with ``drop_on_init`` the warehouse is emptied first."""
    w = load.Warehouse(spark, config.warehouse)
    if config.drop_on_init:
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(w.root)
        root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)
    load.initialise(w, "1990-01-01", "2049-12-31")


def day_files(first: date, last: date, config: Config, fetch=None) -> dict[date, Path]:  # noqa: ANN001
    """The CSV file of each day, downloaded and extracted where it is missing."""
    folder = Path(config.ais_path)
    folder.mkdir(parents=True, exist_ok=True)
    missing = [d for d in ingest.days(first, last) if not (folder / f"aisdk-{d}.csv").exists()]
    archives = ingest.list_archives(config.ais_url, fetch) if missing else {}
    return {d: ingest.ensure_day(d, folder, archives, fetch) for d in ingest.days(first, last)}


def take_day(spark: SparkSession, day: date, config: Config, keep: bool, into_warehouse: bool, fetch=None) -> None:  # noqa: ANN001
    """One day: its kept trajectories if they are there, else built from its file; kept, loaded or both."""
    key, folder = int(f"{day:%Y%m%d}"), f"{config.ais_path.rstrip('/')}/trajectories"
    cache = f"{folder}/day={day}"
    audit = Audit(config.version)
    frame, cached = ais.read_day(spark, cache, "") if ais.finished(spark, cache) else (None, False)
    if not cached:
        path = day_files(day, day, config, fetch)[day]
        audit.file(path.stat().st_size, 0)
        frame = ais.read_reports(spark, str(path))
        if keep:
            built, _ = load.build_day(frame, day=key)
            frame, cached = spark.read.parquet(ais.write_day_cache(built, folder, str(day))), True
    if into_warehouse:
        w = load.Warehouse(spark, config.warehouse)
        if cached:
            load.load_trajectories(w, frame, key, sizes=config.cell_sizes, audit=audit)
        else:
            load.load_day(w, frame, day=key, sizes=config.cell_sizes, audit=audit)


def main(argv: list[str] | None = None, spark: SparkSession | None = None, fetch=None) -> None:  # noqa: ANN001
    args = parser().parse_args(argv)
    config = load_config(args.config)
    if (args.load or args.clean_standalone or args.ensure_files) and (args.from_date is None or args.to_date is None):
        parser().error("--from_date and --to_date are needed")
    if args.ensure_files:
        day_files(args.from_date, args.to_date, config, fetch)
    if not (args.init or args.load or args.clean_standalone):
        return
    spark = spark or SparkSession.builder.appName("fathomline").getOrCreate()
    if args.init:
        initialise(spark, config)
    if args.load or args.clean_standalone:
        for day in ingest.days(args.from_date, args.to_date):
            take_day(spark, day, config, args.clean_standalone, args.load, fetch)


if __name__ == "__main__":
    main(sys.argv[1:])
