"""Row filters and ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose ``columns`` are all non-null (F1); pushed into the scan."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def only_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` IS NULL (F2)."""
    return df.filter(F.col(column).isNull())


def only_positive(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` > 0."""
    return df.filter(F.col(column) > 0)


def not_equal_keep_null(df: DataFrame, column: str, value) -> DataFrame:
    """``column != value`` keeping rows where ``column`` is null."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def in_year(df: DataFrame, column: str, year: int) -> DataFrame:
    """Rows whose date/timestamp ``column`` falls in ``year``.

    Written as a range on the column itself so it can reach the scan.
    """
    start = F.lit(f"{year}-01-01").cast("date")
    end = F.lit(f"{year + 1}-01-01").cast("date")
    c = F.col(column).cast("date")
    return df.filter((c >= start) & (c < end))


def in_date_range(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Rows with ``first <= column <= last`` as dates, both ends kept."""
    c = F.col(column).cast("date")
    return df.filter(c.between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def sort_by(df: DataFrame, columns: Sequence[str], descending: bool = False) -> DataFrame:
    """Global order (O1, O2): a range exchange plus a sort per partition."""
    return df.orderBy(*[F.col(c).desc() if descending else F.col(c).asc() for c in columns])


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First rows for a look at the data (O3); the limit is the feature."""
    return df.limit(n)
