"""End to end on hand-written source files: CSV -> 17 tables -> gate -> B1-B5.

The fixture covers the edge rows every source set should include: duplicate
movie id, null and unparsable ids, doubled quotes, null revenue, ``[]``,
null, blank and truncated nested text, ``None`` literals, ``O'Brien``,
``\\xa0``, ``[1, 2]``, gender 0-3 and null, a person in cast and crew, a
movie in two countries and with two companies, language codes en/de/xx, a
rating and credits for an unknown movie, a second file per family, and an
empty prefix.
"""

from __future__ import annotations

import os

import pytest

from nestmart.plans import load, quality, questions
from nestmart.sinks import warehouse as sink
from nestmart.sources import read_prefix
from nestmart.schemas import RATINGS_SCHEMA

from .conftest import write_text

MOVIES_HEADER = (
    "adult,belongs_to_collection,budget,genres,homepage,id,imdb_id,original_language,original_title,overview,"
    "popularity,poster_path,production_companies,production_countries,release_date,revenue,runtime,"
    "spoken_languages,status,tagline,title,video,vote_average,vote_count\n"
)


def _movie(mid, genres, companies, countries, languages, date, revenue, title, orig_lang="en"):
    q = lambda s: '"' + s.replace('"', '""') + '"' if s is not None else ""
    return (
        f"False,,500.0,{q(genres)},,{mid},tt{mid},{orig_lang},{q(title)},{q('An overview, with commas')},"
        f"1.5,/p.jpg,{q(companies)},{q(countries)},{date},{revenue},90,{q(languages)},Released,,{q(title)},False,7.5,10\n"
    )


ACTION = "[{'id': 28, 'name': 'Action'}]"
MOVIES = MOVIES_HEADER + "".join(
    [
        _movie(10, ACTION, "[{'name': 'Studio A', 'id': 1}, {'name': 'Studio B', 'id': 2}]",
               "[{'iso_3166_1': 'DE', 'name': 'Germany'}, {'iso_3166_1': 'US', 'name': 'United States of America'}]",
               "[{'iso_639_1': 'en', 'name': 'English'}]", "2004-05-01", "1000.0", "First"),
        _movie(10, ACTION, "[{'name': 'Studio A', 'id': 1}, {'name': 'Studio B', 'id': 2}]",
               "[{'iso_3166_1': 'DE', 'name': 'Germany'}, {'iso_3166_1': 'US', 'name': 'United States of America'}]",
               "[{'iso_639_1': 'en', 'name': 'English'}]", "2004-05-01", "1000.0", "First"),
        _movie(20, "[{'id': 28, 'name': 'Action'}, {'id': 18, 'name': 'Drama'}]", "[{'name': 'Studio B', 'id': 2}]",
               "[{'iso_3166_1': 'DE', 'name': 'Germany'}]", "[{'iso_639_1': 'de', 'name': 'Deutsch'}]",
               "2012-03-03", "2000.0", 'The "Big" One', "de"),
        _movie(30, "[]", "", None, "[{'iso_639_1': 'xx', 'name': 'No Language'}]", "2020-01-10", "", "Silent", "xx"),
        _movie(40, "[{'id': 28, 'name': 'Act", "[{'name': 'Studio C', 'id': 3, 'logo': None}]", "[1, 2]",
               "[{'iso_639_1': 'en', 'name': 'English'}]", "2020-06-01", "3000.0", "Late"),
        _movie("", ACTION, "[]", "[]", "[]", "2001-01-01", "5.0", "No id"),
        _movie("abc", ACTION, "[]", "[]", "[]", "2001-01-01", "5.0", "Bad id"),
    ]
)

CREDITS = (
    "cast,crew,id\n"
    '"[{\'character\': \'Hero\', \'gender\': 1, \'id\': 100, \'name\': ""O\'Brien""}, '
    "{'character': 'Villain', 'gender': 2, 'id': 101, 'name': 'Max'}]\","
    '"[{\'department\': \'Directing\', \'gender\': 1, \'id\': 100, \'job\': \'Director\', \'name\': ""O\'Brien""}]",10\n'
    "\"[{'character': 'Sidekick', 'gender': 0, 'id': 102, 'name': 'Sam'}, "
    "{'character': 'Ghost', 'gender': 3, 'id': 103, 'name': 'Kim'}]\","
    "\"[{'department': 'Writing', 'gender': None, 'id': 104, 'job': 'Writer', 'name': 'Lee'}]\",20\n"
)
CREDITS_2 = (
    "cast,crew,id\n"
    "\"[{'character': 'Hero', 'gender': 1, 'id': 100, 'name': 'O\\'Brien'}, "
    "{'character': 'Twin', 'gender': 1, 'id': 105, 'name': 'Ana\\xa0Lu'}]\",[],30\n"
    "\"[{'character': 'Extra', 'gender': 2, 'id': 106, 'name': 'Bo'}]\",[],90\n"
)
KEYWORDS = "id,keywords\n10,\"[{'id': 1, 'name': 'hero'}, {'id': 2, 'name': 'city'}]\"\n20,\"[{'id': 1, 'name': 'hero'}]\"\n"
KEYWORDS_2 = "id,keywords\n40,\"[{'id': 3, 'name': 'space'}]\"\n"
RATINGS = "userId,movieId,rating,timestamp\n1,10,4.0,1000\n2,10,3.0,1001\n1,20,5.0,1002\n3,999,2.5,1003\n"
RATINGS_2 = "userId,movieId,rating,timestamp\n2,20,4.0,1004\n"


@pytest.fixture()
def sources(tmp_root):
    src = os.path.join(tmp_root, "src")
    write_text(f"{src}/movies_metadata.csv", MOVIES)
    write_text(f"{src}/credits.csv", CREDITS)
    write_text(f"{src}/credits_more/part-1.csv", CREDITS_2)
    write_text(f"{src}/keywords.csv", KEYWORDS)
    write_text(f"{src}/keywords_extra.csv", KEYWORDS_2)
    write_text(f"{src}/ratings.csv", RATINGS)
    write_text(f"{src}/ratings_2/part-1.csv", RATINGS_2)
    return {f: f"{src}/{f}" for f in load.FAMILIES}


def _load(spark, sources, tmp_root, name, mode="append", nested_mode="strict"):
    report = load.run_load(spark, sources, name, os.path.join(tmp_root, name), mode=mode, nested_mode=nested_mode)
    return {(r.rule, r.table, r.column): r.violations for r in report.collect()}, sink.read_all(spark, name)


def _rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_full_load_tables(spark, sources, tmp_root):
    report, w = _load(spark, sources, tmp_root, "nm_fixture_a")
    assert _rows(w["dim_movies"], "id") == [(10,), (20,), (30,), (40,)]
    assert _rows(w["dim_movies"].filter("id = 20"), "title") == [('The "Big" One',)]
    assert _rows(w["fact_movie_sales"], "movie_id", "revenue") == [(10, 1000.0), (20, 2000.0), (30, 0.0), (40, 3000.0)]
    assert _rows(w["movie_genres"], "movie_id", "genre_id") == [(10, 28), (20, 18), (20, 28)]
    assert _rows(w["dim_genres"], "id", "name") == [(18, "Drama"), (28, "Action")]
    assert _rows(w["movie_production_companies"], "movie_id", "company_id") == [(10, 1), (10, 2), (20, 2)]
    assert _rows(w["movie_countries"], "movie_id", "country_code") == [
        (10, "DE"), (10, "US"), (20, "DE"), (40, None), (40, None)
    ]
    assert _rows(w["dim_languages"], "iso_code", "name", "original_name") == [
        ("de", "German", "Deutsch"), ("en", "English", "English"), ("xx", "Unknown language [xx]", "No Language")
    ]
    assert _rows(w["dim_cast"], "id", "name", "gender") == [
        (100, "O'Brien", "F"), (101, "Max", "M"), (102, "Sam", "U"), (103, "Kim", None), (106, "Bo", "M")
    ]
    assert _rows(w["movie_cast"], "movie_id", "cast_id") == [(10, 100), (10, 101), (20, 102), (20, 103), (90, 106)]
    assert _rows(w["movie_crew"], "movie_id", "crew_id") == [(10, 100)]
    assert _rows(w["movie_keywords"], "movie_id", "keyword_id") == [(10, 1), (10, 2), (20, 1), (40, 3)]
    assert _rows(w["fact_rating"], "movie_id", "ratings_count", "ratings_average", "min_rate", "max_rate") == [
        (10, 2, 3.5, 3.0, 4.0), (20, 2, 4.5, 4.0, 5.0), (999, 1, 2.5, 2.5, 2.5)
    ]
    ids = [r.id for r in w["movie_cast"].collect()]
    assert len(set(ids)) == len(ids)
    # the gate reports what the declared keys would have rejected
    assert report[("fk_orphans", "movie_cast", "movie_id")] == 1
    assert report[("fk_orphans", "fact_rating", "movie_id")] == 1
    assert report[("pk_not_null", "dim_countries", "iso_code")] == 1
    assert report[("fk_orphans", "movie_countries", "country_code")] == 0
    failing = {k for k, v in report.items() if v}
    assert failing == {
        ("fk_orphans", "movie_cast", "movie_id"),
        ("fk_orphans", "fact_rating", "movie_id"),
        ("pk_not_null", "dim_countries", "iso_code"),
        ("parse_loss", "movies_metadata", "genres"),
        ("parse_loss", "movies_metadata", "production_companies"),
        ("parse_loss", "credits", "cast"),
        ("parse_loss", "credits", "crew"),
    }
    assert report[("parse_loss", "keywords", "keywords")] == 0 and report[("rejected_rows", "movie_cast", "*")] == 0
    with pytest.raises(quality.QualityError):
        quality.enforce(load.quality.gate(w))


def test_pyliteral_mode_recovers_rows(spark, sources, tmp_root):
    _, w = _load(spark, sources, tmp_root, "nm_fixture_b", nested_mode="pyliteral")
    assert _rows(w["movie_crew"], "movie_id", "crew_id") == [(10, 100), (20, 104)]
    assert (30, 105) in _rows(w["movie_cast"], "movie_id", "cast_id")
    assert _rows(w["dim_cast"].filter("id = 105"), "name") == [("Ana Lu",)]
    assert (40, 3) in _rows(w["movie_production_companies"], "movie_id", "company_id")


def test_questions(spark, sources, tmp_root):
    _, w = _load(spark, sources, tmp_root, "nm_fixture_c")
    assert _rows(questions.question_b1(w, 2020, "en"), "id") == [(30,)]
    assert _rows(questions.question_b2(w, "1990-01-01", "2010-12-31"), "women_cast", "women_crew", "women_total") == [(1, 1, 1)]
    assert _rows(questions.question_b3(w, "DE", "Action", "2010-01-01", "2015-12-31"), "revenue", "movies") == [(2000.0, 1)]
    assert _rows(questions.question_b4(w, "Action", 2004), "id") == [(10,)]
    assert [tuple(r) for r in questions.question_b5(w, "2010-01-01", "2020-12-31").collect()] == [(2, "Studio B", 2000.0, 1)]


def test_overwrite_rerun_is_idempotent(spark, sources, tmp_root):
    _, first = _load(spark, sources, tmp_root, "nm_fixture_d", mode="overwrite")
    before = {n: sorted(map(tuple, df.drop("last_updated", "id" if n.startswith("movie_") else "last_updated").collect()), key=repr) for n, df in first.items()}
    _, second = _load(spark, sources, tmp_root, "nm_fixture_d", mode="overwrite")
    after = {n: sorted(map(tuple, df.drop("last_updated", "id" if n.startswith("movie_") else "last_updated").collect()), key=repr) for n, df in second.items()}
    assert before == after


def test_append_rerun_duplicates_and_ids_continue(spark, sources, tmp_root):
    _, w = _load(spark, sources, tmp_root, "nm_fixture_e")
    _load(spark, sources, tmp_root, "nm_fixture_e")
    w = sink.read_all(spark, "nm_fixture_e")
    assert w["movie_keywords"].count() == 8
    ids = [r.id for r in w["movie_keywords"].collect()]
    assert len(set(ids)) == 8


def test_empty_prefix_gives_typed_empty_frame(spark, tmp_root):
    df = read_prefix(spark, os.path.join(tmp_root, "nothing_here"), RATINGS_SCHEMA, quoted=False)
    assert df.count() == 0 and df.schema == RATINGS_SCHEMA


def test_newline_in_quoted_field(spark, tmp_root):
    from nestmart.sources import read_csv
    from pyspark.sql import types as T

    path = write_text(os.path.join(tmp_root, "nl", "a.csv"), 'id,text,n\n1,"line one\nline two",5\n2,plain,6\n')
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("n", T.IntegerType())])
    multi = sorted(map(tuple, read_csv(spark, path, schema, multi_line=True).collect()))
    assert multi == [(1, "line one\nline two", 5), (2, "plain", 6)]
    single = read_csv(spark, path, schema).filter("id IS NOT NULL").collect()
    assert sorted(r.id for r in single) == [1, 2]


def test_write_reports_observed_rows(spark, sources, tmp_root):
    from nestmart.plans import tables
    from nestmart.sinks.warehouse import create_all, write_table

    create_all(spark, "nm_fixture_f", os.path.join(tmp_root, "f"), ["movie_keywords"])
    raw = load.read_sources(spark, {"keywords": sources["keywords"]})
    _, bridge = tables.keywords(raw["keywords"])
    assert write_table(bridge, "nm_fixture_f", "movie_keywords") == 4


def test_question_b1_on_original_language(spark, sources):
    from nestmart.plans import tables

    raw = load.read_sources(spark, {"movies_metadata": sources["movies_metadata"]})
    staged = tables.staged_movies(raw["movies_metadata"])
    assert _rows(questions.question_b1_original(staged, 2020, "en"), "id") == [(30,)]


def test_bucketed_warehouse_joins_without_shuffle(spark, sources, tmp_root):
    from nestmart.sinks.warehouse import bucket_count

    report, w = _load(spark, sources, tmp_root, "nm_fixture_g")
    plain = {k: v for k, v in report.items()}
    report_b = load.run_load(spark, sources, "nm_fixture_h", os.path.join(tmp_root, "h"), buckets=4)
    assert {(r.rule, r.table, r.column): r.violations for r in report_b.collect()} == plain
    wb = sink.read_all(spark, "nm_fixture_h")
    assert bucket_count(spark, "nm_fixture_h", "movie_genres") == 4
    assert bucket_count(spark, "nm_fixture_h", "dim_genres") is None
    for name in ["dim_movies", "movie_genres", "movie_cast", "fact_rating"]:
        assert sorted(map(tuple, wb[name].drop("id", "last_updated").collect()), key=repr) == sorted(
            map(tuple, w[name].drop("id", "last_updated").collect()), key=repr
        )
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        q = questions.question_b1(wb, 2020, "en")
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert _rows(q, "id") == [(30,)]
        assert "Exchange" not in plan
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_people_pass_equals_separate_explodes(spark, sources):
    from nestmart.plans import tables

    raw = load.read_sources(spark, {"credits": sources["credits"]})["credits"]
    for mode in ["strict", "pyliteral"]:
        one_pass = tables.people_tables(tables.credit_people(raw, mode))
        sep = dict(zip(["dim_cast", "movie_cast"], tables.cast(raw, mode=mode)))
        sep.update(zip(["dim_crew", "movie_crew"], tables.crew(raw, mode=mode)))
        for name, df in sep.items():
            assert one_pass[name].columns == df.columns
            assert _rows(one_pass[name].drop("last_updated"), "*") == _rows(df.drop("last_updated"), "*")


def test_movie_elements_pass_equals_separate_explodes(spark, sources):
    from nestmart.plans import tables

    raw = load.read_sources(spark, {"movies_metadata": sources["movies_metadata"]})["movies_metadata"]
    staged = tables.staged_movies(raw)
    for mode in ["strict", "pyliteral"]:
        one_pass = tables.movie_list_tables(tables.movie_elements(staged, mode))
        sep = {}
        for fn_, names in [(tables.genres, ("dim_genres", "movie_genres")), (tables.companies, ("dim_companies", "movie_production_companies")),
                           (tables.countries, ("dim_countries", "movie_countries")), (tables.languages, ("dim_languages", "movie_languages"))]:
            sep.update(zip(names, fn_(staged, mode=mode)))
        for name, df in sep.items():
            assert one_pass[name].columns == df.columns, name
            assert _rows(one_pass[name].drop("last_updated"), "*") == _rows(df.drop("last_updated"), "*"), name


def test_gate_length_rules(spark, sources, tmp_root):
    from pyspark.sql import functions as F

    _, w = _load(spark, sources, tmp_root, "nm_fixture_i")
    report = {(r.rule, r.table): r.violations for r in quality.gate(w, keys=False, lengths=True).collect()}
    assert report[("max_length", "dim_cast")] == 0 and report[("max_length", "movie_countries")] == 0
    long_name = dict(w, dim_cast=w["dim_cast"].withColumn("name", F.concat(F.col("name"), F.lit("x" * 300))))
    report = {(r.rule, r.table): r.violations for r in quality.gate(long_name, keys=False, lengths=True).collect()}
    assert report[("max_length", "dim_cast")] == 5
