"""Warehouse sinks: create, drop, conform, write, publish."""

from .ledger import compact, drop_unpublished, read_rejects
from .warehouse import (
    conform,
    conform_report,
    create_all,
    current_max_id,
    drop_all,
    read_all,
    write_all,
    write_table,
)

__all__ = [
    "compact",
    "drop_unpublished",
    "read_rejects",
    "conform",
    "conform_report",
    "create_all",
    "current_max_id",
    "drop_all",
    "read_all",
    "write_all",
    "write_table",
]
