"""Loads appear whole, merge where they must, and keep what they refuse."""

from __future__ import annotations

import glob
import os

import pytest

from nestmart.plans import load
from nestmart.sinks import ledger
from nestmart.sinks import warehouse as sink
from nestmart.streaming import run_ingest

from .conftest import write_text

RATINGS = "userId long, movieId long, rating float, timestamp long"
GENRES = "id long, name string, last_updated timestamp"


def _genres(spark, *ids):
    return spark.createDataFrame([(i, f"g{i}", None) for i in ids], GENRES)


def _ids(spark, db, name="dim_genres"):
    return sorted(r.id for r in sink.read_all(spark, db, [name])[name].collect())


def _stats(spark, db):
    rows = sink.read_all(spark, db, ["fact_rating"])["fact_rating"].drop("last_updated").collect()
    return sorted(tuple(r) for r in rows)


def test_rows_are_seen_once_published(spark, tmp_root):
    db = "nm_ledger_a"
    sink.create_all(spark, db, os.path.join(tmp_root, "wh"), ["dim_genres"])
    new = sink.stage_table(_genres(spark, 1, 2), db, "dim_genres", "first")
    assert _ids(spark, db) == [] and spark.table(f"{db}.dim_genres").count() == 0
    sink.stage_table(_genres(spark, 3), db, "dim_genres", "abandoned")
    ledger.publish(spark, db, new)
    assert _ids(spark, db) == [1, 2] and spark.table(f"{db}.dim_genres").count() == 2
    sink.write_table(_genres(spark, 4), db, "dim_genres", "append")
    assert _ids(spark, db) == [1, 2, 4]
    sink.write_table(_genres(spark, 9), db, "dim_genres", "overwrite")
    assert _ids(spark, db) == [9]
    assert ledger.drop_unpublished(spark, db, keep=["abandoned"]) == 2
    assert ledger.drop_unpublished(spark, db) == 1
    assert _ids(spark, db) == [9]


def test_writing_a_load_again_replaces_it(spark, tmp_root):
    db = "nm_ledger_b"
    sink.create_all(spark, db, os.path.join(tmp_root, "wh"), ["dim_genres"])
    sink.stage_table(_genres(spark, 1, 2, 3), db, "dim_genres", "one")
    new = sink.stage_table(_genres(spark, 5), db, "dim_genres", "one")
    ledger.publish(spark, db, new)
    assert _ids(spark, db) == [5]


def test_compaction_keeps_the_rows(spark, tmp_root):
    db = "nm_ledger_c"
    sink.create_all(spark, db, os.path.join(tmp_root, "wh"), ["dim_genres", "fact_rating"], rating_parts=4)
    for i in range(4):
        sink.write_table(_genres(spark, i), db, "dim_genres")
        ratings = spark.createDataFrame([(1, m, float(i), 0) for m in range(i, i + 5)], RATINGS)
        load.write_load(spark, load.stage_ratings(ratings), db, f"r{i}")
    before = _stats(spark, db)
    for name in ("dim_genres", "fact_rating"):
        ledger.compact(spark, db, name)
    live = ledger.live(ledger.entries(spark, db))
    assert len(live["dim_genres"]) == 1 and len(live["fact_rating"]) == 1
    ledger.drop_unpublished(spark, db)
    assert _ids(spark, db) == [0, 1, 2, 3] and _stats(spark, db) == before
    assert before[0][:3] == (0, 1, 0.0) and before[3][:3] == (3, 4, 1.5)


def test_a_batch_rewrites_the_parts_it_touches(spark, tmp_root):
    db = "nm_ledger_d"
    sink.create_all(spark, db, os.path.join(tmp_root, "wh"), ["fact_rating"], rating_parts=8)
    many = spark.createDataFrame([(1, m, 4.0, 0) for m in range(200)], RATINGS)
    load.write_load(spark, load.stage_ratings(many), db, "many")
    live = ledger.live(ledger.entries(spark, db))["fact_rating"]
    assert live == {"many": frozenset(range(8))}
    before = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{tmp_root}/wh/*/load_id=many/*/*.parquet")}
    one = spark.createDataFrame([(2, 77, 2.0, 0)], RATINGS)
    load.write_load(spark, load.stage_ratings(one), db, "one")
    assert {p: os.stat(p).st_mtime_ns for p in before} == before
    live = ledger.live(ledger.entries(spark, db))["fact_rating"]
    assert len(live["one"]) == 1 and live["many"] | live["one"] == frozenset(range(8)) and not live["many"] & live["one"]
    written = sink.read_all(spark, db, ["fact_rating"])["fact_rating"].where("movie_id = 77").first()
    assert (written.ratings_count, written.ratings_average, written.min_rate, written.max_rate) == (2, 3.0, 2.0, 4.0)
    assert len(_stats(spark, db)) == 200


def test_loads_that_replace_the_same_part_at_once(spark, tmp_root):
    db = "nm_ledger_e"
    sink.create_all(spark, db, os.path.join(tmp_root, "wh"), ["fact_rating"], rating_parts=1)
    rating = lambda m: load.stage_ratings(spark.createDataFrame([(1, m, 3.0, 0)], RATINGS)).frames["fact_rating"]
    until = sink.last_seq(spark, db)
    late = sink.stage_table(rating(1), db, "fact_rating", "late")
    load.write_load(spark, load.stage_ratings(spark.createDataFrame([(1, 2, 5.0, 0)], RATINGS)), db, "early")
    with pytest.raises(ledger.LedgerConflict):
        ledger.publish(spark, db, late, until)
    again = sink.stage_table(rating(1), db, "fact_rating", "late")
    ledger.publish(spark, db, again, sink.last_seq(spark, db))
    assert [r[0] for r in _stats(spark, db)] == [1, 2]


def test_batch_and_stream_take_turns(spark, tmp_root):
    db = "nm_ledger_f"
    head = "userId,movieId,rating,timestamp\n"
    landing, ckpt = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "ckpt")
    for i in range(4):
        row = f"{head}{i},{i},{i}.0,1\n{i},7,{i}.0,1\n"
        if i % 2:
            write_text(f"{landing}/r{i}.csv", row)
            run_ingest(spark, "ratings", landing, db, ckpt)
        else:
            write_text(f"{tmp_root}/b{i}/r.csv", row)
            load.run_load(spark, {"ratings": f"{tmp_root}/b{i}"}, db, os.path.join(tmp_root, "wh"))
    assert _stats(spark, db) == [(0, 1, 0.0, 0.0, 0.0), (1, 1, 1.0, 1.0, 1.0), (2, 1, 2.0, 2.0, 2.0), (3, 1, 3.0, 3.0, 3.0), (7, 4, 1.5, 0.0, 3.0)]


def test_refused_rows_and_elements(spark, tmp_root):
    db = "nm_ledger_g"
    long_name = "n" * 300
    text = f"id,keywords\n10,\"[{{'id': '12a', 'name': 'x'}}, {{'id': 2, 'name': 'ok'}}, {{'id': 3, 'name': '{long_name}'}}]\"\n20,\"[{{'id': 4\"\n"
    write_text(f"{tmp_root}/k/k.csv", text)
    report = load.run_load(spark, {"keywords": f"{tmp_root}/k"}, db, os.path.join(tmp_root, "wh"))
    told = {(r.rule, r.table, r.column): r.violations for r in report.collect()}
    assert told[("rejected_rows", "movie_keywords", "*")] == 1 and told[("rejected_rows", "dim_keywords", "*")] == 1
    assert told[("parse_loss", "keywords", "keywords")] == 1
    kept = {(r.table_name, r.reason): r.row for r in ledger.read_rejects(spark, db).collect()}
    assert set(kept) == {("movie_keywords", "id: not bigint: 12a"), ("dim_keywords", "name: over 256 bytes")}
    assert long_name in kept[("dim_keywords", "name: over 256 bytes")]
    assert _ids(spark, db, "dim_keywords") == [2]
    assert sorted((r.movie_id, r.keyword_id) for r in sink.read_all(spark, db, ["movie_keywords"])["movie_keywords"].collect()) == [(10, 2), (10, 3)]


def test_load_ids_are_plain_names(spark, tmp_root):
    with pytest.raises(ValueError):
        load.run_load(spark, {}, "nm_ledger_h", os.path.join(tmp_root, "wh"), load_id="a/b")


def _merged(spark, tmp_root, db, *tables, parts=4):
    sink.create_all(spark, db, os.path.join(tmp_root, "wh", db), list(tables), merge_parts=parts)


def test_survivors_do_not_depend_on_the_split_into_loads(spark, tmp_root):
    rows = [(1, "b", None), (1, "a", None), (2, None, None), (2, "x", None), (None, "n", None), (None, "m", None), (3, "c", None), (3, "c", None)]
    want = [(None, "m"), (1, "a"), (2, None), (3, "c")]
    for i, drops in enumerate(([rows], [rows[:3], rows[3:]], [rows[3:], rows[:3]], [[r] for r in reversed(rows[:4])] + [rows[4:]], [[], rows])):
        db = f"nm_merge_a{i}"
        _merged(spark, tmp_root, db, "dim_genres")
        for drop in drops:
            sink.write_table(spark.createDataFrame(drop, GENRES), db, "dim_genres")
        got = sink.read_all(spark, db, ["dim_genres"])["dim_genres"].select("id", "name").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sink.merges(spark, "nm_merge_a0")


def test_a_merged_load_rewrites_only_the_parts_it_touches(spark, tmp_root):
    db = "nm_merge_b"
    _merged(spark, tmp_root, db, "dim_genres", parts=16)
    sink.write_table(_genres(spark, *range(200)), db, "dim_genres")
    root = os.path.join(tmp_root, "wh")
    before = set(glob.glob(f"{root}/**/*.parquet", recursive=True))
    sink.write_table(_genres(spark, 7, 1000), db, "dim_genres")
    new = [p for p in set(glob.glob(f"{root}/**/*.parquet", recursive=True)) - before if "dim_genres__loads" in p]
    assert 1 <= len({os.path.dirname(p) for p in new}) <= 2
    assert _ids(spark, db) == [*range(200), 1000]
    sink.write_table(_genres(spark, 5), db, "dim_genres", "overwrite")
    assert _ids(spark, db) == [5]
    ledger.compact(spark, db, "dim_genres")
    sink.write_table(_genres(spark, 6), db, "dim_genres")
    assert _ids(spark, db) == [5, 6]


def test_refused_rows_do_not_survive(spark, tmp_root):
    db = "nm_merge_c"
    _merged(spark, tmp_root, db, "dim_genres")
    rows = spark.createDataFrame([("1", "A" * 300, None), ("1", "b", None), ("x", "c", None)], "id string, name string, last_updated timestamp")
    sink.write_table(rows, db, "dim_genres")
    got = sink.read_all(spark, db, ["dim_genres"])["dim_genres"].select("id", "name").collect()
    assert [tuple(r) for r in got] == [(1, "b")]
    assert sorted(r.reason for r in ledger.read_rejects(spark, db).collect()) == ["id: not bigint", "name: over 256 bytes"]


def test_movies_merge_as_whole_rows_by_load_and_stream(spark, tmp_root):
    def movies(title, revenue, ids):
        head = "adult,belongs_to_collection,budget,genres,homepage,id,imdb_id,original_language,original_title,overview,popularity,poster_path,production_companies,production_countries,release_date,revenue,runtime,spoken_languages,status,tagline,title,video,vote_average,vote_count"
        genres = "\"[{'id': 1, 'name': 'g'}]\""
        return "\n".join([head, *(f"False,,1,{genres},,{i},tt,en,o,v,1.0,,[],[],2000-01-01,{revenue},1.0,[],ok,,{title},False,1.0,1" for i in ids)]) + "\n"

    first, second = movies("A", 1, range(40)), movies("B", 2, range(20, 60))
    got = {}
    for step, drops in {"ab": (first, second), "ba": (second, first)}.items():
        db, root = f"nm_merge_{step}", os.path.join(tmp_root, step)
        write_text(f"{root}/batch/movies.csv", drops[0])
        load.run_load(spark, {"movies_metadata": f"{root}/batch/"}, db, os.path.join(root, "wh"), merge_parts=4)
        write_text(f"{root}/landing/movies.csv", drops[1])
        run_ingest(spark, "movies_metadata", f"{root}/landing", db, f"{root}/checkpoint")
        w = sink.read_all(spark, db)
        titles = {r.id: r.title for r in w["dim_movies"].collect()}
        sales = {r.movie_id: r.revenue for r in w["fact_movie_sales"].collect()}
        assert w["dim_movies"].count() == w["fact_movie_sales"].count() == w["movie_genres"].count() == len(titles) == 60
        assert all(sales[i] == {"A": 1, "B": 2}[t] for i, t in titles.items())
        assert w["dim_genres"].select("id", "name").collect() == [(1, "g")]
        got[step] = titles
    assert got["ab"] == got["ba"] and {got["ab"][i] for i in range(20, 40)} == {"A", "B"}
