"""Surrogate row ids (K5).

``with_row_id``: unique, increasing, not dense.  ``monotonically_increasing_id``
needs no shuffle and no coordination; an offset (the target table's current
maximum) keeps appended batches from colliding.

``with_dense_id``: 1..N in a total order without a single-partition window.
The frame is range-partitioned and sorted inside each partition; a small job
counts rows per partition (at most ``spark.sql.shuffle.partitions`` rows,
safe to broadcast) and each row's id is its partition's offset plus its
position.  Partition number and position are written with the rows to the
shared scratch folder, once: counts and rows then read the same partitioning,
whatever columns the rows carry and whatever task is run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def with_row_id(df: DataFrame, column: str = "id", offset: int = 0) -> DataFrame:
    """Prepend a unique id starting above ``offset`` (IDENTITY-like)."""
    rid = (F.monotonically_increasing_id() + F.lit(offset + 1)).alias(column)
    return df.select(rid, *[c for c in df.columns if c != column])


def with_dense_id(
    df: DataFrame,
    order_by: Sequence[str],
    column: str = "id",
    start: int = 1,
    num_partitions: int | None = None,
) -> DataFrame:
    """Prepend ``column`` = position of the row under ``order_by`` + ``start`` - 1.

    ``order_by`` must be a total order (unique) for the ids to be
    reproducible.
    """
    order_by = list(order_by)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
    # position inside the partition: the low 33 bits of the monotonic id
    mono, pid = F.monotonically_increasing_id(), F.spark_partition_id()
    tagged = ranged.select("*", pid.alias("__nm_pid"), (mono - F.shiftleft(pid.cast("long"), 33)).alias("__nm_pos"))
    path = scratch_path(df.sparkSession, "dense-id")
    tagged.write.parquet(path)
    tagged = df.sparkSession.read.schema(tagged.schema).parquet(path)
    sizes = tagged.groupBy("__nm_pid").agg(F.count(F.lit(1)).alias("__nm_n"))
    offsets = sizes.select(
        "__nm_pid",
        (F.sum("__nm_n").over(Window.orderBy("__nm_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("__nm_off"),
    )
    joined = tagged.join(F.broadcast(offsets), "__nm_pid")
    dense = (F.coalesce(F.col("__nm_off"), F.lit(0)) + F.col("__nm_pos") + F.lit(start)).alias(column)
    return joined.select(dense, *[c for c in df.columns if c != column])
