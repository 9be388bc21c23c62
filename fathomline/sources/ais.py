"""Position reports from files, day caches, pixel export."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.schema import AIS_CSV


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Raw reports by file suffix; CSV with a header is what there is. A folder or glob of CSV files works too."""
    suffix = PurePosixPath(path).suffix
    if suffix not in (".csv", ""):
        raise NotImplementedError(f"no reader for {suffix!r} files")
    return spark.read.schema(AIS_CSV).option("header", True).option("enforceSchema", True).csv(path)


def with_file_date(df: DataFrame) -> DataFrame:
    """Adds ``file_date`` from names like aisdk-2021-03-04.csv or aisdk-2021-03.csv (first of the month)."""
    name = F.col("_metadata.file_name")
    part = lambda i: F.regexp_extract(name, r"aisdk-(\d{4})-(\d{2})(?:-(\d{2}))?\.", i)
    day = F.when(part(3) == "", "01").otherwise(part(3))
    return df.withColumn("file_date", F.to_date(F.concat_ws("-", part(1), part(2), day)))


def write_day_cache(df: DataFrame, folder: str, day: str) -> str:
    """Built trajectories of a day as Parquet; replaces an earlier one."""
    path = f"{folder.rstrip('/')}/day={day}"
    df.write.mode("overwrite").parquet(path)
    return path


def finished(spark: SparkSession, folder: str) -> bool:
    """Whether a Parquet folder was written to its end."""
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def read_day(spark: SparkSession, cache: str | None, csv: str) -> tuple[DataFrame, bool]:
    """(frame, cached): the cached trajectories of a day if their folder was written to its end, else its raw reports."""
    if cache is not None and finished(spark, cache):
        return spark.read.parquet(cache), True
    return read_reports(spark, csv), False


def read_table(spark: SparkSession, name: str, url: str | None = None, **options: str) -> DataFrame:
    """A catalog table or Parquet path; with ``url`` a table behind JDBC."""
    if url is not None:
        return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def ascii_grid(pixels: DataFrame, size: int, nodata: float = -9999.0) -> DataFrame:
    """One ESRI ASCII grid (text) for each partition_id of (partition_id, pixel_x, pixel_y, value); a partition bounds its grid."""

    def draw(pdf):  # noqa: ANN001
        import numpy as np
        import pandas as pd

        x0, y0 = int(pdf["pixel_x"].min()), int(pdf["pixel_y"].min())
        grid = np.full((int(pdf["pixel_y"].max()) - y0 + 1, int(pdf["pixel_x"].max()) - x0 + 1), nodata)
        grid[pdf["pixel_y"].to_numpy() - y0, pdf["pixel_x"].to_numpy() - x0] = pdf["value"].to_numpy()
        head = f"ncols {grid.shape[1]}\nnrows {grid.shape[0]}\nxllcorner {x0 * size}\nyllcorner {y0 * size}\ncellsize {size}\nNODATA_value {nodata:g}\n"
        return pd.DataFrame({"partition_id": [pdf["partition_id"].iloc[0]], "grid": [head + "\n".join(" ".join(f"{v:g}" for v in row) for row in grid[::-1]) + "\n"]})

    kind = pixels.schema["partition_id"].dataType.simpleString()
    return pixels.groupBy("partition_id").applyInPandas(draw, f"partition_id {kind}, grid string")
