"""Incremental ingest: files landing in rounds, one checkpoint."""

from __future__ import annotations

import os

from nestmart.sinks.warehouse import create_all
from nestmart.streaming import run_ingest

from .conftest import write_text


def _stats(spark, db):
    rows = spark.table(f"{db}.fact_rating").drop("last_updated").collect()
    return sorted(tuple(r) for r in rows)


def test_ratings_ingest_in_rounds_matches_batch(spark, tmp_root):
    db = "nm_stream_a"
    create_all(spark, db, os.path.join(tmp_root, "wh"), ["fact_rating"])
    landing, ckpt = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "ckpt")
    write_text(f"{landing}/r1.csv", "userId,movieId,rating,timestamp\n1,10,4.0,1\n2,10,3.0,2\n1,20,5.0,3\n")
    run_ingest(spark, "ratings", landing, db, ckpt)
    assert _stats(spark, db) == [(10, 2, 3.5, 3.0, 4.0), (20, 1, 5.0, 5.0, 5.0)]
    write_text(f"{landing}/r2.csv", "userId,movieId,rating,timestamp\n3,10,2.0,4\n2,20,4.0,5\n4,30,1.0,6\n")
    run_ingest(spark, "ratings", landing, db, ckpt)
    want = [(10, 3, 3.0, 2.0, 4.0), (20, 2, 4.5, 4.0, 5.0), (30, 1, 1.0, 1.0, 1.0)]
    assert _stats(spark, db) == want
    run_ingest(spark, "ratings", landing, db, ckpt)  # nothing new: nothing changes
    assert _stats(spark, db) == want


def test_dimension_keys_appended_once(spark, tmp_root):
    db = "nm_stream_b"
    create_all(spark, db, os.path.join(tmp_root, "wh"), ["dim_keywords", "movie_keywords"])
    landing, ckpt = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "ckpt")
    write_text(f"{landing}/k1.csv", "id,keywords\n10,\"[{'id': 1, 'name': 'hero'}, {'id': 2, 'name': 'city'}]\"\n")
    run_ingest(spark, "keywords", landing, db, ckpt)
    write_text(f"{landing}/k2.csv", "id,keywords\n20,\"[{'id': 1, 'name': 'hero'}, {'id': 3, 'name': 'space'}]\"\n")
    run_ingest(spark, "keywords", landing, db, ckpt)
    dim = sorted((r.id, r.name) for r in spark.table(f"{db}.dim_keywords").collect())
    assert dim == [(1, "hero"), (2, "city"), (3, "space")]
    bridge = spark.table(f"{db}.movie_keywords").collect()
    assert sorted((r.movie_id, r.keyword_id) for r in bridge) == [(10, 1), (10, 2), (20, 1), (20, 3)]
    assert len({r.id for r in bridge}) == 4


def test_movies_ingest_skips_loaded_movies(spark, tmp_root):
    from .test_pipeline import MOVIES_HEADER, _movie

    db = "nm_stream_c"
    create_all(spark, db, os.path.join(tmp_root, "wh"))
    landing, ckpt = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "ckpt")
    action = "[{'id': 28, 'name': 'Action'}]"
    langs = "[{'iso_639_1': 'en', 'name': 'English'}]"
    first = _movie(10, action, "[{'name': 'Studio A', 'id': 1}]", "[{'iso_3166_1': 'DE', 'name': 'Germany'}]", langs, "2004-05-01", "1000.0", "First")
    write_text(f"{landing}/m1.csv", MOVIES_HEADER + first)
    run_ingest(spark, "movies_metadata", landing, db, ckpt)
    second = _movie(50, "[{'id': 28, 'name': 'Action'}, {'id': 18, 'name': 'Drama'}]", "[{'name': 'Studio A', 'id': 1}]",
                    "[{'iso_3166_1': 'FR', 'name': 'France'}]", langs, "2010-01-01", "10.0", "Second")
    write_text(f"{landing}/m2.csv", MOVIES_HEADER + first + second)  # movie 10 delivered again
    run_ingest(spark, "movies_metadata", landing, db, ckpt)

    def rows(table, *cols):
        return sorted(tuple(r) for r in spark.table(f"{db}.{table}").select(*cols).collect())

    assert rows("dim_movies", "id") == [(10,), (50,)]
    assert rows("movie_genres", "movie_id", "genre_id") == [(10, 28), (50, 18), (50, 28)]
    assert rows("dim_genres", "id") == [(18,), (28,)]
    assert rows("dim_companies", "id") == [(1,)]
    assert rows("dim_countries", "iso_code") == [("DE",), ("FR",)]
    assert rows("dim_languages", "iso_code", "name") == [("en", "English")]
    assert rows("fact_movie_sales", "movie_id", "revenue") == [(10, 1000.0), (50, 10.0)]


def test_credits_ingest_appends_people_once(spark, tmp_root):
    db = "nm_stream_d"
    create_all(spark, db, os.path.join(tmp_root, "wh"), ["dim_cast", "movie_cast", "dim_crew", "movie_crew"])
    landing, ckpt = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "ckpt")
    head = "cast,crew,id\n"
    ann = "{'character': 'Hero', 'gender': 1, 'id': 100, 'name': 'Ann'}"
    write_text(f"{landing}/c1.csv", head + f"\"[{ann}]\",\"[{{'department': 'Art', 'gender': 2, 'id': 7, 'job': 'Painter', 'name': 'Bob'}}]\",10\n")
    run_ingest(spark, "credits", landing, db, ckpt)
    write_text(f"{landing}/c2.csv", head + f"\"[{ann}, {{'character': 'Twin', 'gender': 0, 'id': 101, 'name': 'Cy'}}]\",[],20\n")
    run_ingest(spark, "credits", landing, db, ckpt)
    cast = sorted((r.id, r.name, r.gender) for r in spark.table(f"{db}.dim_cast").collect())
    assert cast == [(100, "Ann", "F"), (101, "Cy", "U")]
    assert sorted((r.movie_id, r.cast_id) for r in spark.table(f"{db}.movie_cast").collect()) == [(10, 100), (20, 100), (20, 101)]
    assert sorted((r.id, r.job, r.gender) for r in spark.table(f"{db}.dim_crew").collect()) == [(7, "Painter", "M")]


def test_replayed_batches_lose_and_repeat_nothing(spark, tmp_root, monkeypatch):
    from nestmart.plans import load

    from .test_pipeline import MOVIES_HEADER, _movie

    db = "nm_stream_replay"
    create_all(spark, db, os.path.join(tmp_root, "wh"))
    landing, ckpt = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "ckpt")
    langs = "[{'iso_639_1': 'en', 'name': 'English'}]"
    row = _movie(10, "[{'id': 28, 'name': 'Action'}]", "[{'name': 'A', 'id': 1}]", "[{'iso_3166_1': 'DE', 'name': 'Germany'}]", langs, "2004-05-01", "1000.0", "First")
    write_text(f"{landing}/movies/m1.csv", MOVIES_HEADER + row)
    write_text(f"{landing}/keywords/k1.csv", "id,keywords\n10,\"[{'id': 1, 'name': 'hero'}, {'id': 2, 'name': 'city'}]\"\n")
    real, fails = load.stage_table, [True]

    def write_then_fail(df, database, name, *args):
        out = real(df, database, name, *args)
        if fails and name in ("movie_genres", "movie_keywords"):
            fails.clear()
            raise OSError("lost after this table")
        return out

    monkeypatch.setattr(load, "stage_table", write_then_fail)
    for family, folder in (("movies_metadata", "movies"), ("keywords", "keywords")):
        fails[:] = [True]
        try:
            run_ingest(spark, family, f"{landing}/{folder}", db, f"{ckpt}/{family}")
        except Exception:
            assert not fails
        run_ingest(spark, family, f"{landing}/{folder}", db, f"{ckpt}/{family}")
    for table, n in (("dim_movies", 1), ("fact_movie_sales", 1), ("dim_genres", 1), ("movie_genres", 1), ("movie_countries", 1), ("dim_keywords", 2), ("movie_keywords", 2)):
        spark.catalog.refreshTable(f"{db}.{table}")
        assert spark.table(f"{db}.{table}").count() == n, table


def test_ratings_stream_continues_a_batch_load(spark, tmp_root):
    from nestmart.plans.tables import fact_rating
    from nestmart.sinks.warehouse import write_table

    db = "nm_stream_seed"
    create_all(spark, db, os.path.join(tmp_root, "wh"), ["fact_rating"])
    loaded = spark.createDataFrame([(1, 1, 4.0, 1), (2, 1, 2.0, 1), (1, 2, 5.0, 1)], "userId long, movieId long, rating float, timestamp long")
    write_table(fact_rating(loaded), db, "fact_rating")
    landing = os.path.join(tmp_root, "landing")
    write_text(f"{landing}/r1.csv", "userId,movieId,rating,timestamp\n3,1,3.0,1\n")
    run_ingest(spark, "ratings", landing, db, os.path.join(tmp_root, "ckpt"))
    assert _stats(spark, db) == [(1, 3, 3.0, 2.0, 4.0), (2, 1, 5.0, 5.0, 5.0)]
