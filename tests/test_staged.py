"""Work that is done once: nested texts parsed, catalogs derived, drops written."""

import glob
import os

import pytest

from nestmart import functions as fn
from nestmart.plans import load, registry, tables

TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "EUROPE"), (1, "ASIA")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(7, "GERMANY", 0), (8, "JAPAN", 1)]),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int", [(1, "S1", 7), (2, "S2", 8)]),
    "part": ("p_partkey bigint, p_name string, p_type string, p_brand string, p_size int", [(1, "one", "PROMO", "Brand#11", 14), (2, "two", "STANDARD", "Brand#12", 1)]),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        None,
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_discount double, l_shipdate timestamp_ntz",
        None,
    ),
}


@pytest.fixture()
def small(spark, tmp_root):
    for name, (schema, rows) in TABLES.items():
        if rows:
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_root}/{name}.parquet")
    day = "timestamp_ntz'1997-02-03 00:00:00'"
    spark.sql(f"SELECT id o_orderkey, 5L o_custkey, 'P' o_orderstatus, 10.5D * id o_totalprice, {day} o_orderdate, '1-URGENT' o_orderpriority FROM range(1, 5)").write.parquet(f"{tmp_root}/orders.parquet")
    spark.sql(f"SELECT 1 + id div 2 l_orderkey, 1 + id % 2 l_partkey, 1 + id % 2 l_suppkey, CAST(1 + id % 2 AS int) l_linenumber, 20D l_quantity, 0.1D l_discount, {day} l_shipdate FROM range(6)").write.parquet(f"{tmp_root}/lineitem.parquet")
    return tmp_root


def _parses(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(ArrayType(MapType")


def test_a_list_is_parsed_once(spark):
    movies = spark.createDataFrame([(1, '[{"id": 1, "name": "a"}, 2]'), (2, "[]"), (3, None), (4, "[{")], "id long, genres string")
    rows = tables.movie_elements(movies, lists=["genres"])
    assert _parses(rows) == 1
    assert sorted((r.movie_id, r.key or "", r.name or "") for r in rows.collect()) == [(1, "", ""), (1, "1", "a")]
    words = movies.withColumnRenamed("genres", "keywords")
    assert _parses(tables.keyword_elements(words)) == 1
    assert sorted((r.movie_id, r.id or 0) for r in tables.keyword_elements(words).collect()) == [(1, 0), (1, 1)]
    exploded = fn.explode_json(movies, "genres", [("name", "name")])
    assert _parses(exploded) == 1 and sorted((r.id, r.name or "") for r in exploded.collect()) == [(1, ""), (1, "a")]


def test_tables_read_lists_that_are_staged_once(spark, small):
    w = registry._warehouse(spark, small)
    for name, tag in (("movie_genres", "elements"), ("dim_companies", "elements"), ("movie_crew", "people"), ("dim_cast", "people"), ("movie_keywords", "keywords")):
        assert all(f"/warehouse-{tag}-" in f for f in w[name].inputFiles()), name
    assert {r["table"]: r["rows"] for r in registry.star_load(spark, small).collect()}["movie_crew"] == 6
    assert not [r for r in registry.quality_gate(spark, small).collect() if r["violations"]]
    assert [tuple(r) for r in registry.question_b2(spark, small).collect()] == [(2, 1, 2)]  # people 1 and 2 in the cast, 1 in the crew
    assert registry.QUERIES["table_movie_crew"](spark, small).count() == 6
    assert "movie_genres" not in registry._warehouse(spark, small, ["spoken_languages"], ["movies_metadata"])


def test_movies_are_derived_once(spark, small):
    """Both movie tables and the parse read the staged movies, not the catalog again."""
    w = registry._warehouse(spark, small, ["genres"], ["movies_metadata"])
    for name in ("dim_movies", "fact_movie_sales"):
        assert w[name].inputFiles() and all("/warehouse-movies-" in f for f in w[name].inputFiles()), name
    assert sorted((r.movie_id, r.revenue) for r in w["fact_movie_sales"].collect()) == [(i, 10.5 * i) for i in range(1, 5)]


def test_drops_are_written_once_for_all_orders(spark, small, monkeypatch):
    written = []
    write = load.write_sources
    monkeypatch.setattr(load, "write_sources", lambda frames, root: written.append(root) or write(frames, root))
    rows = registry.merged_movies(spark, small).collect()
    assert len(written) == 2
    assert sorted(tuple(r) for r in rows) == [(step, 4, 0, 0, 6) for step in ("one", "reversed", "two")]
    assert not any(os.path.exists(root) for root in written)


def test_landed_files_are_compressed(spark, tmp_root):
    movies = spark.createDataFrame([(1, '[{"id": 1, "name": "a"}]')], "id long, keywords string")
    prefixes = load.write_sources({"keywords": movies}, tmp_root)
    assert glob.glob(f"{tmp_root}/keywords/*.csv.gz") and not glob.glob(f"{tmp_root}/keywords/*.csv")
    assert [tuple(r) for r in load.read_sources(spark, prefixes)["keywords"].collect()] == [tuple(r) for r in movies.collect()]
