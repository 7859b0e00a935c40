"""Declared source schemas, the 17 target tables and their key registry.

Sources are headered CSV files that bind columns **by position** to these
schemas (no inference).  Targets follow the warehouse DDL: 8 dimensions,
2 facts and 7 bridge tables with a surrogate ``id``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Source schemas, in file column order.
# ---------------------------------------------------------------------------
MOVIES_SCHEMA = T.StructType(
    [
        T.StructField("adult", T.BooleanType()),
        T.StructField("belongs_to_collection", T.StringType()),  # nested text
        T.StructField("budget", T.DoubleType()),
        T.StructField("genres", T.StringType()),  # nested text
        T.StructField("homepage", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("imdb_id", T.StringType()),
        T.StructField("original_language", T.StringType()),
        T.StructField("original_title", T.StringType()),
        T.StructField("overview", T.StringType()),
        T.StructField("popularity", T.FloatType()),
        T.StructField("poster_path", T.StringType()),
        T.StructField("production_companies", T.StringType()),  # nested text
        T.StructField("production_countries", T.StringType()),  # nested text
        T.StructField("release_date", T.DateType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("runtime", T.IntegerType()),
        T.StructField("spoken_languages", T.StringType()),  # nested text
        T.StructField("status", T.StringType()),
        T.StructField("tagline", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("video", T.BooleanType()),
        T.StructField("vote_average", T.FloatType()),
        T.StructField("vote_count", T.IntegerType()),
    ]
)

CREDITS_SCHEMA = T.StructType(
    [
        T.StructField("cast", T.StringType()),  # nested text
        T.StructField("crew", T.StringType()),  # nested text
        T.StructField("id", T.LongType()),
    ]
)

KEYWORDS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("keywords", T.StringType()),  # nested text
    ]
)

RATINGS_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("movieId", T.LongType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

SOURCE_SCHEMAS = {
    "movies_metadata": MOVIES_SCHEMA,
    "credits": CREDITS_SCHEMA,
    "keywords": KEYWORDS_SCHEMA,
    "ratings": RATINGS_SCHEMA,
}

# movies, credits and keywords quote with '"' and escape '"'; ratings uses
# the reader defaults.
QUOTED_SOURCES = ("movies_metadata", "credits", "keywords")


# ---------------------------------------------------------------------------
# Target tables.
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    max_len: int | None = None  # byte length limit of varchar/char columns


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = field(default_factory=tuple)
    identity: str | None = None  # surrogate id column filled on write

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type) for c in self.columns])

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]


_I, _L, _S, _D = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType()
_TS, _DT, _B = T.TimestampType(), T.DateType(), T.BooleanType()

# Warehouse varchar limits (bytes).  A bare varchar holds 256
# bytes, varchar(max) 65535.
VARCHAR = 256
VARCHAR_MAX = 65535


def _dim(name: str, key: Column, *rest: Column) -> Table:
    return Table(name, (key, *rest, Column("last_updated", _TS)), (key.name,))


def _bridge(name: str, ref: Column, parent: str, parent_column: str) -> Table:
    return Table(
        name,
        (Column("id", _L), Column("movie_id", _L), ref),
        ("id",),
        (
            ForeignKey("movie_id", "dim_movies", "id"),
            ForeignKey(ref.name, parent, parent_column),
        ),
        identity="id",
    )


TABLES: dict[str, Table] = {
    t.name: t
    for t in [
        _dim(
            "dim_cast",
            Column("id", _L),
            Column("name", _S, 255),
            Column("character", _S, VARCHAR),
            Column("gender", _S, 1),
        ),
        _dim(
            "dim_crew",
            Column("id", _L),
            Column("name", _S, 255),
            Column("department", _S, VARCHAR),
            Column("gender", _S, 1),
            Column("job", _S, VARCHAR),
        ),
        _dim("dim_keywords", Column("id", _L), Column("name", _S, VARCHAR)),
        _dim("dim_genres", Column("id", _L), Column("name", _S, VARCHAR)),
        _dim("dim_companies", Column("id", _L), Column("name", _S, VARCHAR)),
        _dim("dim_countries", Column("iso_code", _S, 2), Column("name", _S, VARCHAR)),
        _dim(
            "dim_languages",
            Column("iso_code", _S, 2),
            Column("name", _S, VARCHAR),
            Column("original_name", _S, VARCHAR),
        ),
        _dim(
            "dim_movies",
            Column("id", _L),
            Column("title", _S, VARCHAR),
            Column("original_title", _S, VARCHAR),
            Column("overview", _S, VARCHAR_MAX),
            Column("status", _S, VARCHAR),
            Column("release_date", _DT),
            Column("video", _B),
        ),
        Table(
            "fact_rating",
            (
                Column("movie_id", _L),
                Column("ratings_count", _L),
                Column("ratings_average", _D),
                Column("min_rate", _D),
                Column("max_rate", _D),
                Column("last_updated", _TS),
            ),
            ("movie_id",),
            (ForeignKey("movie_id", "dim_movies", "id"),),
        ),
        Table(
            "fact_movie_sales",
            (
                Column("movie_id", _L),
                Column("revenue", _D),
                Column("budget", _D),
                Column("vote_average", _D),
                Column("vote_count", _I),
                Column("last_updated", _TS),
            ),
            ("movie_id",),
            (ForeignKey("movie_id", "dim_movies", "id"),),
        ),
        _bridge("movie_cast", Column("cast_id", _L), "dim_cast", "id"),
        _bridge("movie_crew", Column("crew_id", _L), "dim_crew", "id"),
        _bridge("movie_genres", Column("genre_id", _L), "dim_genres", "id"),
        _bridge("movie_keywords", Column("keyword_id", _L), "dim_keywords", "id"),
        _bridge(
            "movie_production_companies", Column("company_id", _L), "dim_companies", "id"
        ),
        _bridge(
            "movie_languages", Column("language_code", _S, 2), "dim_languages", "iso_code"
        ),
        _bridge(
            "movie_countries", Column("country_code", _S, 2), "dim_countries", "iso_code"
        ),
    ]
}

# Creation order: parents before children.  Dropping walks it backwards.
CREATE_ORDER = [
    "dim_movies",
    "dim_cast",
    "dim_crew",
    "dim_keywords",
    "dim_genres",
    "dim_companies",
    "dim_countries",
    "dim_languages",
    "fact_rating",
    "fact_movie_sales",
    "movie_cast",
    "movie_crew",
    "movie_genres",
    "movie_keywords",
    "movie_production_companies",
    "movie_languages",
    "movie_countries",
]
assert sorted(CREATE_ORDER) == sorted(TABLES)


def movie_key(table: str) -> str | None:
    """The column holding the movie id (the natural bucketing key), if any."""
    if table == "dim_movies":
        return "id"
    for fk in TABLES[table].foreign_keys:
        if fk.parent == "dim_movies":
            return fk.column
    return None


def foreign_keys() -> list[tuple[str, ForeignKey]]:
    return [(t, fk) for t in CREATE_ORDER for fk in TABLES[t].foreign_keys]
