"""Joins the warehouse questions and checks use.

Semi- and anti-joins first reduce the right side to its distinct keys.  That
is a partial aggregation, so a hot key collapses map-side and the join never
sees a third of the table under one key from the right.  Broadcast or
shuffle is left to Spark: the static size threshold and AQE's runtime
statistics decide, i.e. a side is broadcast only after its size was
measured.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pairs(left_keys: Sequence[str], right_keys: Sequence[str] | None):
    left_keys = list(left_keys)
    right_keys = list(right_keys or left_keys)
    if len(left_keys) != len(right_keys):
        raise ValueError("key lists differ in length")
    return left_keys, right_keys


def _keys_only(right: DataFrame, right_keys: list[str]) -> tuple[DataFrame, list[str]]:
    names = [f"__nm_k{i}" for i in range(len(right_keys))]
    keys = right.select(*[F.col(k).alias(n) for k, n in zip(right_keys, names)]).distinct()
    return keys, names


def semi_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str] | None = None) -> DataFrame:
    """Left rows with at least one match (EXISTS); never multiplies rows."""
    lk, rk = _pairs(left_keys, right_keys)
    keys, names = _keys_only(right, rk)
    cond = [left[a] == keys[b] for a, b in zip(lk, names)]
    return left.join(keys, cond, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str] | None = None) -> DataFrame:
    """Left rows without a match (NOT EXISTS; a null key never matches)."""
    lk, rk = _pairs(left_keys, right_keys)
    keys, names = _keys_only(right, rk)
    cond = [left[a] == keys[b] for a, b in zip(lk, names)]
    return left.join(keys, cond, "left_anti")


def inner_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Plain equi-join (J1); use only where multiplying rows is intended."""
    return left.join(right, on, "inner")
