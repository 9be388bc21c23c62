"""Helpers shared by the corpus operators: table access, shared-folder tables, text batches."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes handed to a Python worker at once, whichever comes first; a single text is never cut.
BATCH_ROWS = 512
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is ``spark.checkpoint.dir``; only where the session has none and runs on one machine (tests) it is a temporary
    folder of this process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir names no folder that the driver and all executors share")
    return (named or _own_dir()).rstrip("/")


@functools.cache
def _own_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="fathomline-")


#: The folders that each open ``scratch`` deletes at its end, the innermost last.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """At the end, deletes what ``staged`` has written inside, but for what is to be kept: that is left to the scope around this one, if any."""
    mine: list[str] = []
    token = _scopes.set((*_scopes.get(), mine))
    try:
        yield
    finally:
        _scopes.reset(token)
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        for path in mine:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)


#: Whether the shuffle files of an execution go at its end; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts lineage, survives lost executors.

    The files stay, but inside ``scratch`` they go at its end, with ``keep`` at the end of the scope around it. Nothing reads the
    write's shuffle files again, so they go at once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    scopes = _scopes.get()[: -1 if keep else None]
    if scopes:
        scopes[-1].append(path)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session; its queries run lazily, so the bound stays."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def lean(run: Callable) -> Callable:
    """``run``, a generator over Arrow batches, whose worker gives its memory back to the system when a task ends: workers are reused."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def dicts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Arrow batches as dictionaries of Python lists."""
    for b in batches:
        if b.num_rows:
            yield b.to_pydict()
