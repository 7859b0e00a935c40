"""Nested text columns: lists of dicts stored as JSON-like text.

``explode_json`` turns one such column into one output row per element, with
chosen dict keys as typed columns (N1-N6).  It is a narrow transformation
(Project -> Generate -> Project): no shuffle, no Python, everything inside
whole-stage codegen, so it scales with the number of input partitions.

Semantics kept from the original pipeline (Spark 4 behavior):

* null, blank, malformed, truncated or ``[]`` text gives no rows (``explode``,
  not ``explode_outer``);
* a non-object element such as ``1`` in ``[1, 2]`` gives a row of nulls;
* a missing key gives null; a nested object is rendered back to JSON text;
* casts are lenient (``try_cast``) and an integral cast truncates ``'8.0'``
  to 8 as the non-ANSI cast did, instead of failing the job.

``mode="pyliteral"`` additionally repairs Python-literal text (``None``,
``True``, ``False``, ``\\xNN``) on the rows strict parsing rejects only, so a
word like ``None`` inside a well-formed string is never touched.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pyliteral import python_literal_to_json
from .scalar import safe_cast

LIST_OF_TEXT = T.ArrayType(T.StringType())
TEXT_MAP = T.MapType(T.StringType(), T.StringType())
LIST_OF_MAPS = T.ArrayType(TEXT_MAP)

# Lenient JSON reader options used for repaired Python-literal text.
_PYLITERAL_OPTIONS = {
    "allowSingleQuotes": "true",
    "allowBackslashEscapingAnyCharacter": "true",
    "allowNonNumericNumbers": "true",
}


@dataclass(frozen=True)
class Key:
    """One dict key to pull out: ``dict_key`` -> column ``output``.

    ``type`` (a DataType or DDL string) casts the looked-up text leniently.
    """

    dict_key: str
    output: str
    type: T.DataType | str | None = None


def _as_keys(keys: Iterable[Key | Mapping | tuple]) -> list[Key]:
    out = []
    for k in keys:
        if isinstance(k, Key):
            out.append(k)
        elif isinstance(k, Mapping):
            out.append(Key(k["dict_key"], k.get("df_output_column", k.get("output")), k.get("column_type", k.get("type"))))
        else:
            out.append(Key(*k))
    return out


# Python literal tokens and their JSON spelling.
_PY_TOKENS = {"None": "null", "True": "true", "False": "false"}


def _outside_strings(token: str) -> str:
    """Regex matching everything up to the next ``token`` that is not inside
    a quoted string.  ``\\G`` chains matches; quoted strings (single or
    double, with backslash escapes) are consumed whole, so a token inside
    one is never reached.  Possessive quantifiers keep the Java regex from
    backtracking or recursing deeply on long texts.
    """
    first, rest = token[0], token[1:]
    single = r"'[^'\\]*+(?:\\.[^'\\]*+)*+'"
    double = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    return rf"""\G((?:[^'"{first}]++|{single}|{double}|{first}(?!{rest}\b))*+)(?<![\w]){token}\b"""


def repair_pyliteral(text: Column) -> Column:
    """Rewrite Python-literal text into JSON the reader accepts.

    Bare ``None``/``True``/``False`` outside strings become
    ``null``/``true``/``false``; ``\\xNN`` escapes become ``\\u00NN`` so the
    JSON reader decodes them to the same character.  Single quotes are
    accepted by the reader as they are.
    """
    fixed = text
    for token, json_value in _PY_TOKENS.items():
        fixed = F.regexp_replace(fixed, _outside_strings(token), f"$1{json_value}")
    return F.regexp_replace(fixed, r"(?<!\\)((?:\\\\)*+)\\x([0-9a-fA-F]{2})", "$1\\\\u00$2")


def parse_list(text: Column, mode: str = "strict") -> Column:
    """Text -> ``array<string>``, one JSON text per element."""
    strict = F.from_json(text, LIST_OF_TEXT)
    if mode == "strict":
        return strict
    if mode == "pyliteral":
        return F.coalesce(strict, F.from_json(repair_pyliteral(text), LIST_OF_TEXT, _PYLITERAL_OPTIONS))
    raise ValueError(f"unknown mode {mode!r}")


def parse_dict(element: Column) -> Column:
    """Element text -> ``map<string,string>``."""
    return F.from_json(element, TEXT_MAP)


def _elements(text: Column, options: Mapping[str, str] | None = None) -> Column:
    """Text -> ``array<map<string,string>>`` with two-step semantics.

    One parse straight into maps is about twice as fast and gives the same
    maps whenever it succeeds; it returns null only where some element is not
    an object (``[1, 2]``), and there the lazy ``coalesce`` falls back to the
    element-wise parse (list of texts, then each text to a map), which keeps
    such elements as null maps.
    """
    opts = dict(options or {})
    direct = F.from_json(text, LIST_OF_MAPS, opts)
    stepwise = F.transform(F.from_json(text, LIST_OF_TEXT, opts), lambda e: F.from_json(e, TEXT_MAP, opts))
    return F.coalesce(direct, stepwise)


def parse_elements(text: Column, mode: str = "strict") -> Column:
    """Text -> list of dicts (N1 + N3 in one expression).

    ``strict``: JSON with single quotes allowed (the original behavior).
    ``pyliteral``: rejected rows get a JVM-side regex repair first.
    ``python``: rejected rows are decoded exactly by ``ast.literal_eval`` in a
    vectorized (Arrow) pandas UDF; rows that parse strictly reach the UDF as
    nulls, so Python only does work for the rejected ones.
    """
    strict = _elements(text)
    if mode == "strict":
        return strict
    if mode == "pyliteral":
        return F.coalesce(strict, _elements(repair_pyliteral(text), _PYLITERAL_OPTIONS))
    if mode == "python":
        rejected = F.when(strict.isNull(), text)
        return F.coalesce(strict, _elements(python_literal_to_json(rejected)))
    raise ValueError(f"unknown mode {mode!r}")


def explode_json(
    df: DataFrame,
    column: str,
    keys: Sequence[Key | Mapping | tuple],
    mode: str = "strict",
) -> DataFrame:
    """One row per element of nested text ``column``.

    The input columns are kept (including ``column``); each key becomes a
    column, replacing a same-named input column in place, new ones appended
    in key order.
    """
    keys = _as_keys(keys)
    parsed = "__nm_map"
    # explode_outer without its empty row: before explode Spark filters on the list's
    # size, which parses the text twice
    held = F.transform(parse_elements(F.col(column), mode), lambda m: F.struct(m.alias("m")))
    mapped = df.select("*", F.explode_outer(held).alias(parsed)).where(F.col(parsed).isNotNull())

    def lookup(k: Key) -> Column:
        value = F.col(f"{parsed}.m").getItem(k.dict_key)
        if k.type is not None:
            value = safe_cast(value, k.type)
        return value.alias(k.output)

    by_name = {k.output: k for k in keys}
    kept = [lookup(by_name[c]) if c in by_name else F.col(c) for c in df.columns]
    added = [lookup(k) for k in keys if k.output not in df.columns]
    return mapped.select(*kept, *added)


def nested_parse_report(df: DataFrame, column: str, by: Sequence[str] | None = None) -> DataFrame:
    """Counts of what ``explode_json`` drops for ``column``, in one pass.

    ``unparsed`` rows have text that strict parsing rejects (all of their
    elements are lost in strict mode); ``repairable`` of those parse after the
    Python-literal repair.  ``by`` gives one row per group instead of one.
    """
    text = F.col(column)
    strict = parse_list(text, "strict")
    lenient = parse_list(text, "pyliteral")
    has_text = text.isNotNull() & (F.trim(text) != "")
    aggs = [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~has_text | text.isNull()).alias("null_or_blank"),
        F.count_if(has_text & strict.isNotNull() & (F.size(strict) == 0)).alias("empty_list"),
        F.count_if(has_text & strict.isNull()).alias("unparsed"),
        F.count_if(has_text & strict.isNull() & lenient.isNotNull()).alias("repairable"),
        F.coalesce(F.sum(F.when(strict.isNotNull(), F.size(strict)).otherwise(0)), F.lit(0)).alias("elements"),
    ]
    if by:
        return df.groupBy(*by).agg(*aggs)
    return df.agg(*aggs).select(F.lit(column).alias("column"), "*")


def scan_chunks(df: DataFrame, max_elements: int = 1000, column: str = "__nm_chunk") -> DataFrame:
    """Tag rows with a chunk number: runs of ``max_elements`` consecutive rows
    of one input partition share a number.

    Call it directly on a file scan, before any shuffle: the scan's
    partitions and row order are fixed, so a retried task assigns the same
    numbers.
    """
    return df.withColumn(column, F.floor(F.monotonically_increasing_id() / F.lit(max_elements)))


def split_large(df: DataFrame, key: str, max_elements: int = 1000, chunk: str = "__nm_chunk") -> DataFrame:
    """Keep the chunk number of keys with more than ``max_elements`` rows and
    drop it (null) for all others, so that only large keys are split.

    Two phases: rows are counted per key (combined map-side), and the keys over
    the limit, at most one in ``max_elements`` rows, are joined back.
    """
    large = df.groupBy(F.col(key).alias("__nm_large")).agg(F.count(F.lit(1)).alias("__nm_n")).filter(F.col("__nm_n") > max_elements)
    marked = df.join(large.select("__nm_large", F.lit(True).alias("__nm_split")), F.col(key).eqNullSafe(F.col("__nm_large")), "left")
    return marked.withColumn(chunk, F.when(F.col("__nm_split"), F.col(chunk))).drop("__nm_large", "__nm_split")


def nest_json(
    df: DataFrame,
    key: Sequence[str],
    elements: Mapping[str, Column],
    output: str,
    max_elements: int = 1000,
    extra: Mapping[str, Column] | None = None,
    chunk: str | None = None,
) -> DataFrame:
    """Inverse of ``explode_json``: one JSON list text per key and chunk.

    Every input row becomes one object ``{name: expr, ...}``.  A key's list is
    split into chunks of at most ``max_elements`` objects (the ``chunk``
    column from ``scan_chunks``, or consecutive rows of one partition if not
    given), so a hot key never builds one unbounded value in one task; each
    chunk is one output row and exploding all of them returns the original
    bag.  ``collect_list`` is combined map-side before the shuffle.

    ``extra`` adds further list columns built from the same rows.
    """
    chunk_col = F.col(chunk) if chunk else F.floor(F.monotonically_increasing_id() / F.lit(max_elements))
    lists = {output: elements, **(extra or {})}
    staged = df.select(
        *[F.col(k) for k in key],
        chunk_col.alias("__nm_chunk_key"),
        *[F.struct(*[expr.alias(name) for name, expr in spec.items()]).alias(f"__nm_{col}") for col, spec in lists.items()],
    )
    grouped = staged.groupBy(*key, "__nm_chunk_key").agg(
        *[F.collect_list(f"__nm_{col}").alias(f"__nm_{col}") for col in lists]
    )
    return grouped.select(*key, *[F.to_json(f"__nm_{col}").alias(col) for col in lists])
