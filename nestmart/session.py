"""Session helpers: a local session for tests and benches, and the shared
scratch/checkpoint folder every job writes intermediate files to.

On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
system such as HDFS or an object store).  We only pick our own folder when the
session has none, which is the case in unit tests.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "nestmart",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session with AQE on, the UI off and UTC session time."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.aggregatePushdown", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Root of the shared folder named by ``spark.checkpoint.dir``.

    A local session without such a setting (tests) gets a fresh folder,
    registered as the checkpoint directory, so ``DataFrame.checkpoint()`` and
    our scratch writes land in the same place.  On a cluster a machine's own
    folder would not be shared, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="nestmart-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new, unique folder under the shared root (never reused)."""
    return f"{shared_root(spark)}/nestmart/{tag}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders that nothing will read again."""
    root = f"{shared_root(spark)}/nestmart/"
    for path in paths:
        if not path.startswith(root):
            raise ValueError(f"not a scratch folder: {path}")
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that ends inside go with it, not when the driver collects
    garbage.  For writes whose frames are not run again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=eager)
