"""Aggregations (A1-A3) and row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def group_stats(
    df: DataFrame,
    key: str | Sequence[str],
    value: str,
    count_col: str | None = None,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """``count``/``avg``/``min``/``max`` of ``value`` per key (A1).

    ``count`` counts non-null ``count_col`` (default ``value``).  Partial
    aggregation runs before the shuffle, so hot keys cost one row per map
    task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    n = {"count": "count", "avg": "avg", "min": "min", "max": "max", **(names or {})}
    return df.groupBy(*keys).agg(
        F.count(F.col(count_col or value)).alias(n["count"]),
        F.avg(value).alias(n["avg"]),
        F.min(value).alias(n["min"]),
        F.max(value).alias(n["max"]),
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, rows)`` for many frames as one job (A2)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that fills in when ``df`` is written (A2).

    Avoids the separate ``count()`` job before each write.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def distinct_count(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """Exact distinct count (A3)."""
    return df.agg(F.count_distinct(column).alias(alias or f"distinct_{column}"))
