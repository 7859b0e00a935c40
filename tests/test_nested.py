"""Nested text semantics (one test per pinned behavior)."""

from __future__ import annotations

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nestmart.functions import Key, explode_json, nest_json, nested_parse_report, safe_cast

KEYS = [Key("id", "id", "int"), Key("name", "name")]


def _explode(spark, texts, mode="strict", keys=KEYS):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row int, txt string")
    return sorted(tuple(r) for r in explode_json(df, "txt", keys, mode).drop("txt").collect())


def test_single_quotes_and_apostrophe_name(spark):
    rows = _explode(spark, ["[{'id': 1, 'name': 'A'}, {'id': 2, 'name': \"O'Brien\"}]"])
    assert rows == [(0, 1, "A"), (0, 2, "O'Brien")]


def test_null_blank_garbage_truncated_and_empty_give_no_rows(spark):
    assert _explode(spark, [None, "", "   ", "garbage", "[{'id': 1, 'name': 'A'", "[]", "{'id': 1}"]) == []


def test_python_none_drops_whole_list_in_strict_mode(spark):
    text = "[{'id': 1, 'name': 'A'}, {'id': 2, 'name': None}]"
    assert _explode(spark, [text]) == []
    assert _explode(spark, [text], mode="pyliteral") == [(0, 1, "A"), (0, 2, None)]


def test_non_object_element_gives_row_of_nulls(spark):
    assert _explode(spark, ["[1, 2]"]) == [(0, None, None), (0, None, None)]


def test_missing_key_and_nested_object(spark):
    keys = [Key("id", "id", "int"), Key("extra", "extra")]
    rows = _explode(spark, ['[{"id": 1, "extra": {"a": 1}}, {"id": 2}]'], keys=keys)
    assert rows[0][0:2] == (0, 1) and json.loads(rows[0][2]) == {"a": 1}
    assert rows[1] == (0, 2, None)


def test_lenient_integral_cast(spark):
    df = spark.createDataFrame([("8",), ("8.0",), (" -3.75 ",), ("12a",), ("",), (None,)], "v string")
    got = [r[0] for r in df.select(safe_cast(F.col("v"), "int")).collect()]
    assert got == [8, 8, -3, None, None, None]


def test_pyliteral_keeps_words_inside_strings(spark):
    text = "[{'id': 1, 'name': 'Yes, None, maybe', 'ok': True}]"
    assert _explode(spark, [text], mode="pyliteral") == [(0, 1, "Yes, None, maybe")]


def test_pyliteral_decodes_hex_escapes(spark):
    rows = _explode(spark, ["[{'id': 1, 'name': 'Ana\\xa0Lu', 'x': None}]"], mode="pyliteral")
    assert rows == [(0, 1, "Ana Lu")]


def test_output_column_replaces_input_in_place(spark):
    df = spark.createDataFrame([(7, "[{'id': 1, 'name': 'A'}]", "old")], "movie int, txt string, name string")
    out = explode_json(df, "txt", KEYS)
    assert out.columns == ["movie", "txt", "name", "id"]
    assert out.first()["name"] == "A"


def test_parse_report_counts_losses(spark):
    df = spark.createDataFrame(
        [("[{'id': 1}]",), ("[{'id': None}]",), ("[]",), (None,), ("oops",)], "txt string"
    )
    r = nested_parse_report(df, "txt").first().asDict()
    assert (r["rows"], r["null_or_blank"], r["empty_list"], r["unparsed"], r["repairable"], r["elements"]) == (5, 1, 1, 2, 1, 1)


def test_explode_is_narrow(spark):
    df = spark.createDataFrame([(1, "[{'id': 1, 'name': 'A'}]")], "movie int, txt string")
    plan = explode_json(df, "txt", KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


rows_strategy = st.lists(
    st.tuples(st.integers(0, 5), st.integers(-1000, 1000), st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=8)),
    max_size=40,
)


@settings(max_examples=15, deadline=None)
@given(rows=rows_strategy, chunk=st.integers(1, 4))
def test_nest_then_explode_returns_the_bag(spark, rows, chunk):
    df = spark.createDataFrame(rows, "k int, id int, name string")
    nested = nest_json(df, ["k"], {"id": F.col("id"), "name": F.col("name")}, "items", max_elements=chunk)
    back = explode_json(nested, "items", KEYS).select("k", "id", "name")
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_hot_key_lists_stay_bounded(spark):
    from nestmart.functions import scan_chunks

    # one key with a third of 3,000 rows, spread over 4 partitions
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").cast("int").alias("id"),
        F.lit("x").alias("name"),
    ).repartition(4)
    tagged = scan_chunks(df, 50)
    nested = nest_json(tagged, ["k"], {"id": F.col("id"), "name": F.col("name")}, "items", 50, chunk="__nm_chunk")
    sizes = [r.n for r in nested.select(F.size(F.from_json("items", "array<string>")).alias("n")).collect()]
    assert max(sizes) <= 50
    back = explode_json(nested, "items", KEYS)
    assert back.filter("k = 0").count() == 1000 and back.count() == 3000


def test_python_mode_decodes_exactly(spark):
    text = "[{'id': 1, 'name': 'Yes, None, maybe', 'x': None, 'pair': (1, 2)}, {'id': 2, 'name': 'Ana\\xa0Lu', 'ok': True}]"
    keys = [Key("id", "id", "int"), Key("name", "name"), Key("pair", "pair"), Key("ok", "ok")]
    rows = _explode(spark, [text, "[{'id': 3, 'name': 'fine'}]", "not a literal", None], mode="python", keys=keys)
    assert rows == [(0, 1, "Yes, None, maybe", "[1,2]", None), (0, 2, "Ana\xa0Lu", None, "true"), (1, 3, "fine", None, None)]
