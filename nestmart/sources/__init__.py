"""Scans: CSV by path or key prefix, JDBC tables, parquet tables, views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .csv import empty_frame, read_csv, read_prefix, write_csv
from .jdbc import jdbc_options, read_table

# The supplied benchmark tables.
TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_parquet_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Expose ``df`` to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
    return df


__all__ = [
    "TABLE_NAMES",
    "empty_frame",
    "jdbc_options",
    "read_csv",
    "read_parquet_table",
    "read_prefix",
    "read_table",
    "register_view",
    "write_csv",
]
