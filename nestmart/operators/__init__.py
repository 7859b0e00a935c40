"""Relational building blocks: dedup, aggregates, joins, ids, filters."""

from .aggregate import distinct_count, group_stats, observed, row_counts
from .dedup import dedup_by_key
from .filters import (
    in_date_range,
    in_year,
    keep_not_null,
    not_equal_keep_null,
    only_null,
    only_positive,
    preview,
    sort_by,
)
from .joins import anti_join, inner_join, semi_join
from .keys import with_dense_id, with_row_id

__all__ = [
    "anti_join",
    "dedup_by_key",
    "distinct_count",
    "group_stats",
    "in_date_range",
    "in_year",
    "inner_join",
    "keep_not_null",
    "not_equal_keep_null",
    "observed",
    "only_null",
    "only_positive",
    "preview",
    "row_counts",
    "semi_join",
    "sort_by",
    "with_dense_id",
    "with_row_id",
]
