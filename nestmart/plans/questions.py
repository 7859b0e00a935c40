"""The analytical questions the warehouse answers.

All take the warehouse as a mapping of table name -> DataFrame (freshly
built frames or tables read back).  Membership tests are semi/anti joins on
distinct keys, so a movie matched by several bridge rows is never counted
twice and hot keys are collapsed map-side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import in_date_range, in_year
from ..operators.joins import anti_join, semi_join


def _money(col: str) -> F.Column:
    """Exact cents for sums of money (no float drift across plans)."""
    return F.col(col).cast("decimal(18,2)")


def movies_with_genre(w: Mapping[str, DataFrame], genre_name: str) -> DataFrame:
    genre_ids = w["dim_genres"].filter(F.col("name") == genre_name).select("id")
    return semi_join(w["movie_genres"], genre_ids, ["genre_id"], ["id"]).select("movie_id")


def question_b1(w: Mapping[str, DataFrame], year: int, language: str = "en") -> DataFrame:
    """Movies released in ``year`` with at least one spoken language and none
    equal to ``language``."""
    movies = in_year(w["dim_movies"], "release_date", year)
    langs = w["movie_languages"]
    spoken = semi_join(movies, langs, ["id"], ["movie_id"])
    other = anti_join(spoken, langs.filter(F.col("language_code") == language), ["id"], ["movie_id"])
    return other.select("id", "title")


def question_b1_original(movies: DataFrame, year: int, language: str = "en") -> DataFrame:
    """B1 on the staged movies' ``original_language`` (the profiling variant):
    released in ``year`` and not originally in ``language``; a missing
    language counts as different (null-safe, as the pandas ``!=`` did)."""
    released = in_year(movies, "release_date", year)
    return released.filter(~F.col("original_language").eqNullSafe(F.lit(language))).select("id", "title")


def question_b2(w: Mapping[str, DataFrame], first: str, last: str) -> DataFrame:
    """Women (gender ``F``) in the cast or crew of movies released in
    ``[first, last]``: distinct people per role and overall."""
    movies = in_date_range(w["dim_movies"], "release_date", first, last).select("id")

    def women(bridge: str, ref: str, dim: str) -> DataFrame:
        people = semi_join(w[bridge], movies, ["movie_id"], ["id"]).select(F.col(ref).alias("person_id"))
        female = w[dim].filter(F.col("gender") == "F").select("id")
        return semi_join(people.distinct(), female, ["person_id"], ["id"])

    cast, crew = women("movie_cast", "cast_id", "dim_cast"), women("movie_crew", "crew_id", "dim_crew")
    tagged = cast.select("person_id", F.lit(1).alias("in_cast"), F.lit(0).alias("in_crew")).unionByName(
        crew.select("person_id", F.lit(0).alias("in_cast"), F.lit(1).alias("in_crew"))
    )
    per_person = tagged.groupBy("person_id").agg(F.max("in_cast").alias("c"), F.max("in_crew").alias("r"))
    return per_person.agg(
        F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("women_cast"),
        F.coalesce(F.sum("r"), F.lit(0)).cast("long").alias("women_crew"),
        F.count(F.lit(1)).alias("women_total"),
    )


def question_b3(w: Mapping[str, DataFrame], country: str, genre_name: str, first: str, last: str) -> DataFrame:
    """Revenue of movies made in ``country`` with genre ``genre_name``,
    released in ``[first, last]``."""
    movies = in_date_range(w["dim_movies"], "release_date", first, last).select("id")
    movies = semi_join(movies, w["movie_countries"].filter(F.col("country_code") == country), ["id"], ["movie_id"])
    movies = semi_join(movies, movies_with_genre(w, genre_name), ["id"], ["movie_id"])
    sales = semi_join(w["fact_movie_sales"], movies, ["movie_id"], ["id"])
    return sales.agg(
        F.coalesce(F.sum(_money("revenue")), F.lit(0)).cast("double").alias("revenue"),
        F.count(F.lit(1)).alias("movies"),
    )


def question_b4(w: Mapping[str, DataFrame], genre_name: str, year: int) -> DataFrame:
    """Movies of genre ``genre_name`` released in ``year``."""
    movies = in_year(w["dim_movies"], "release_date", year)
    return semi_join(movies, movies_with_genre(w, genre_name), ["id"], ["movie_id"]).select("id", "title", "release_date")


def question_b5(w: Mapping[str, DataFrame], first: str, last: str) -> DataFrame:
    """Per production company: revenue and number of its movies released in
    ``[first, last]``, highest revenue first."""
    movies = in_date_range(w["dim_movies"], "release_date", first, last).select("id")
    pairs = w["movie_production_companies"].select("movie_id", "company_id").distinct()
    pairs = semi_join(pairs, movies, ["movie_id"], ["id"])
    sales = w["fact_movie_sales"].select("movie_id", _money("revenue").alias("rev"))
    per_company = pairs.join(sales, "movie_id").groupBy("company_id").agg(
        F.sum("rev").cast("double").alias("revenue"),
        F.count(F.lit(1)).alias("movies"),
    )
    names = w["dim_companies"].select(F.col("id").alias("company_id"), F.col("name").alias("company_name"))
    out = per_company.join(names, "company_id", "left")
    return out.select("company_id", "company_name", "revenue", "movies").orderBy(F.col("revenue").desc(), "company_id")
