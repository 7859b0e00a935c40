"""Column-level functions: nested text, casts, labels, language names."""

from .languages import language_names, unknown_language, with_language_name
from .nested import (
    Key,
    explode_json,
    nest_json,
    nested_parse_report,
    parse_dict,
    parse_elements,
    parse_list,
    repair_pyliteral,
    scan_chunks,
    split_large,
)
from .scalar import (
    GENDER_LABELS,
    code_label,
    fill_numeric_nulls,
    gender_label,
    not_equal_keep_null,
    safe_cast,
    with_audit,
)

__all__ = [
    "GENDER_LABELS",
    "Key",
    "code_label",
    "explode_json",
    "fill_numeric_nulls",
    "gender_label",
    "language_names",
    "nest_json",
    "nested_parse_report",
    "not_equal_keep_null",
    "parse_dict",
    "parse_elements",
    "parse_list",
    "repair_pyliteral",
    "safe_cast",
    "scan_chunks",
    "split_large",
    "unknown_language",
    "with_audit",
    "with_language_name",
]
