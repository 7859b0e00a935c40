"""Small constant tables as SQL ``VALUES`` relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def values_frame(spark: SparkSession, rows: Sequence[Sequence], columns: Sequence[str]) -> DataFrame:
    """A local relation with planner statistics (unlike an RDD-backed
    ``createDataFrame``), so joins against it can be broadcast."""
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(f"`{c}`" for c in columns)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")
