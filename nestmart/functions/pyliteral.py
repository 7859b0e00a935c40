"""Exact decoding of Python-literal text (``repr`` of lists of dicts).

A small per-row helper run as an Arrow-batched pandas UDF; callers pass only
the rows strict JSON parsing rejected (others arrive as null).
"""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _to_json(text):
    if text is None:
        return None
    try:
        value = ast.literal_eval(text)
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None
    try:
        return json.dumps(value, ensure_ascii=False, default=str)
    except (TypeError, ValueError):
        return None


@F.pandas_udf(T.StringType())
def python_literal_to_json(texts: pd.Series) -> pd.Series:
    """Python literal text -> JSON text (null when it is not a literal)."""
    return texts.map(_to_json, na_action="ignore")
