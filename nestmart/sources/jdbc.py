"""Database table scan.

The original reads a whole warehouse table through one JDBC connection, so
one task pulls every row.  Here the caller may give a numeric
``partition_column`` with bounds; Spark then opens ``num_partitions``
connections, each reading one stride, and pushes filters and the column list
into each query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def read_table(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """``spark.read.format('jdbc')`` over ``table`` with optional striping."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()
