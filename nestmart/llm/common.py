"""Shared steps of the operators: reading tables and per-batch Arrow maps."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nestmart.session import _CLEANUP, scratch_path, shuffles_removed  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application
    (they may not have it on their path)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="nestmart-src-"), "nestmart_src.zip")
    with zipfile.ZipFile(path, "w") as out:
        for top, _, names in os.walk(home):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(home)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def give_back() -> None:
    """Return freed memory to the system: a worker lives on for later tasks, beside other workers
    and the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def map_partitions(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)

    def whole(batches):
        give_back()  # also what a worker kept that other steps have used
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(whole, schema)


def map_batches(df: DataFrame, step: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` of a step that turns one batch into batches."""

    def run(batches):
        for batch in batches:
            yield from step(batch)

    return map_partitions(df, run, schema)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared scratch folder and read back: the lineage is cut, later
    steps survive lost executors, and the shuffle files behind it are removed."""
    path = scratch_path(df.sparkSession, tag)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lowest(df: DataFrame, by: str, hash_col: str, order: list[str], n: int, salts: int = 64) -> DataFrame:
    """The ``n`` first rows per value of ``by``, in order.  Ranked within salted groups
    first, so that the task that ranks a hot value sees at most ``salts * n`` rows,
    however many tasks the rows come from."""
    for salt in ([F.pmod(hash_col, F.lit(salts))], []):
        rank = F.row_number().over(Window.partitionBy(by, *salt).orderBy(*order))
        df = df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
    return df
