"""Lineitem is joined once for all frames of the catalog, and shuffle files go with the write that made them."""

import os

from pyspark.sql import functions as F

from nestmart.plans import catalog, load, registry
from nestmart.session import _CLEANUP
from nestmart.sinks import ledger

from .test_staged import small  # noqa: F401


def _rows(df):
    return sorted(str(r.asDict()) for r in df.collect())


def test_frames_from_stored_lines_are_the_same(spark, small):  # noqa: F811
    t = catalog.load_tables(spark, small)
    odd_parts = t["part"].selectExpr("p_partkey + 10 AS p_partkey", "p_name", "CAST(NULL AS string) AS p_type", "p_brand", "p_size")
    more = t["lineitem"].withColumns({"l_partkey": t["lineitem"].l_partkey + 10})
    t["part"] = t["part"].unionByName(odd_parts)
    t["supplier"] = t["supplier"].unionByName(t["supplier"].where("s_suppkey = 1"))  # a key that comes twice
    orphans = t["lineitem"].selectExpr("l_orderkey", "l_partkey", "CAST(NULL AS bigint) AS l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_shipdate")
    t["lineitem"] = t["lineitem"].unionByName(more).unionByName(orphans)
    paths = []
    shared = registry._with_lines(spark, t, paths)
    for frame, lists in ((catalog.movies_frame, []), (catalog.credits_frame, ["cast", "crew"]), (catalog.keywords_frame, ["keywords"])):
        one, other = frame(t), frame(shared)
        for c in lists:  # the order inside a list is open
            parse = f"array_sort(from_json(`{c}`, 'array<map<string,string>>'), (a, b) -> CASE WHEN to_json(a) < to_json(b) THEN -1 WHEN to_json(a) > to_json(b) THEN 1 ELSE 0 END)"
            one, other = (x.withColumn(c, F.expr(parse)) for x in (one, other))
        assert _rows(one) == _rows(other) and one.columns == other.columns
    assert len(paths) == 2


def test_lines_are_joined_once_and_removed(spark, small, monkeypatch):  # noqa: F811
    joined = []
    geo = catalog._supplier_geo
    monkeypatch.setattr(catalog, "_supplier_geo", lambda t: joined.append(1) or geo(t))
    kept = []
    remove = registry.remove_scratch
    monkeypatch.setattr(registry, "remove_scratch", lambda spark, *paths: kept.extend(paths) or remove(spark, *paths))
    registry._warehouse(spark, small)
    assert len(joined) == 1 and len(kept) == 2 and not any(os.path.exists(p.removeprefix("file:")) for p in kept)
    registry._landed(spark, small, registry.scratch_path(spark, "t"))
    assert len(joined) == 2


def test_movies_of_both_drops_are_derived_once(spark, small, monkeypatch):  # noqa: F811
    read = []
    write = load.write_sources
    monkeypatch.setattr(load, "write_sources", lambda frames, root: read.extend(f for df in frames.values() for f in df.inputFiles()) or write(frames, root))
    registry.merged_movies(spark, small).collect()
    assert read and all("/merged-source-" in f for f in read)


def test_loads_drop_their_shuffle_files(spark, small, monkeypatch):  # noqa: F811
    seen = []
    insert = ledger.insert
    monkeypatch.setattr(ledger, "insert", lambda df, *a: seen.append(df.sparkSession.conf.get(_CLEANUP, None)) or insert(df, *a))
    before = spark.conf.get(_CLEANUP, None)
    registry.full_load(spark, small).collect()
    assert seen and set(seen) == {"true"} and spark.conf.get(_CLEANUP, None) == before
