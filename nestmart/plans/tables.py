"""The 17 table builders.

Every builder is a lazy DataFrame over the raw source frames; nothing runs
until a sink writes.  Shapes follow the warehouse DDL; bridge surrogate ids
are added by the sink on write (``sinks.warehouse.conform``).

Shuffles: one per dimension (dedup by key, combined map-side), one for
``staged_movies`` (dedup by id) and one for ``fact_rating`` (group by movie).
Exploding nested text is narrow.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.languages import with_language_name
from ..functions.nested import Key, explode_json, parse_elements
from ..functions.scalar import fill_numeric_nulls, gender_label, safe_cast, with_audit
from ..operators.dedup import dedup_by_key
from ..operators.filters import keep_not_null

# Dict keys read from each nested column.
GENRE_KEYS = [Key("id", "genre_id", "bigint"), Key("name", "genre_name")]
COMPANY_KEYS = [Key("id", "company_id", "bigint"), Key("name", "company_name")]
COUNTRY_KEYS = [Key("iso_3166_1", "country_code"), Key("name", "country_name")]
LANGUAGE_KEYS = [Key("iso_639_1", "language_code"), Key("name", "language_name")]
CAST_KEYS = [Key("id", "id", "bigint"), Key("name", "name"), Key("character", "character"), Key("gender", "gender", "int")]
CREW_KEYS = [
    Key("id", "id", "bigint"),
    Key("name", "name"),
    Key("department", "department"),
    Key("gender", "gender", "int"),
    Key("job", "job"),
]
KEYWORD_KEYS = [Key("id", "id", "bigint"), Key("name", "name")]

DIM_MOVIES_COLUMNS = ["id", "title", "original_title", "overview", "status", "release_date", "video"]
SALES_COLUMNS = ["movie_id", "revenue", "budget", "vote_average", "vote_count"]


#: Value of ``reproducible`` for warehouses that merge survivors across loads: rows of a
#: key are left to the sink, which keeps the least one.
MERGED = "merged"


def _dedup(df: DataFrame, key: str, reproducible: bool | str) -> DataFrame:
    """D1 by default; with ``reproducible`` the smallest row survives."""
    if reproducible == MERGED:
        return df
    if not reproducible:
        return dedup_by_key(df, [key])
    others = [c for c in df.columns if c != key]
    return dedup_by_key(df, [key], order_by=others) if others else df.dropDuplicates([key])


def staged_movies(raw: DataFrame, reproducible: bool | str = False) -> DataFrame:
    """Keep rows with an id, one row per id, numeric nulls -> 0.  To be merged
    across loads, the row with the least hash of all its columns stays, and carries it."""
    kept = keep_not_null(raw, "id")
    if reproducible == MERGED:
        kept = kept.withColumn("order_key", F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns]))))
        return fill_numeric_nulls(dedup_by_key(kept, ["id"], order_by=["order_key"]))
    return fill_numeric_nulls(_dedup(kept, "id", reproducible))


def _order_key(movies: DataFrame) -> list[str]:
    return [c for c in movies.columns if c == "order_key"]


def dim_movies(movies: DataFrame) -> DataFrame:
    """T2."""
    return with_audit(movies.select(*DIM_MOVIES_COLUMNS, *_order_key(movies)))


def fact_movie_sales(movies: DataFrame) -> DataFrame:
    """One row per movie, id renamed ``movie_id``."""
    sales = movies.withColumnRenamed("id", "movie_id").select(*SALES_COLUMNS, *_order_key(movies))
    return with_audit(sales.withColumn("vote_average", F.col("vote_average").cast("double")))


def _dim_and_bridge(
    movies: DataFrame,
    column: str,
    keys: list[Key],
    dim_rename: Mapping[str, str],
    bridge_ref: str,
    reproducible: bool,
    mode: str,
) -> tuple[DataFrame, DataFrame]:
    exploded = explode_json(movies.withColumnRenamed("id", "movie_id"), column, keys, mode=mode)
    src_key = keys[0].output
    dim = _dedup(exploded.select(*[k.output for k in keys]), src_key, reproducible)
    dim = with_audit(dim.withColumnsRenamed(dict(dim_rename)))
    bridge = exploded.select("movie_id", F.col(src_key).alias(bridge_ref))
    return dim, bridge


def genres(movies: DataFrame, reproducible: bool | str = False, mode: str = "strict"):
    """T4: ``dim_genres`` and ``movie_genres``."""
    return _dim_and_bridge(movies, "genres", GENRE_KEYS, {"genre_id": "id", "genre_name": "name"}, "genre_id", reproducible, mode)


def companies(movies: DataFrame, reproducible: bool | str = False, mode: str = "strict"):
    """T5: ``dim_companies`` and ``movie_production_companies``."""
    return _dim_and_bridge(
        movies, "production_companies", COMPANY_KEYS, {"company_id": "id", "company_name": "name"}, "company_id", reproducible, mode
    )


def countries(movies: DataFrame, reproducible: bool | str = False, mode: str = "strict"):
    """``dim_countries`` and ``movie_countries`` (string keys, no cast)."""
    return _dim_and_bridge(
        movies, "production_countries", COUNTRY_KEYS, {"country_code": "iso_code", "country_name": "name"}, "country_code", reproducible, mode
    )


def languages(movies: DataFrame, reproducible: bool | str = False, mode: str = "strict", sort: bool = True):
    """``dim_languages`` (with English names) and ``movie_languages``."""
    exploded = explode_json(movies.withColumnRenamed("id", "movie_id"), "spoken_languages", LANGUAGE_KEYS, mode=mode)
    dim = _dedup(exploded.select("language_code", "language_name"), "language_code", reproducible)
    dim = dim.withColumnsRenamed({"language_code": "iso_code", "language_name": "original_name"})
    dim = with_language_name(dim, "iso_code", "name").select("iso_code", "name", "original_name")
    dim = with_audit(dim)
    if sort:
        dim = dim.orderBy("iso_code")
    bridge = exploded.select("movie_id", "language_code")
    return dim, bridge


def _people(credits: DataFrame, column: str, keys: list[Key], dim_cols: list[str], ref: str, reproducible: bool, mode: str):
    exploded = explode_json(credits.withColumnRenamed("id", "movie_id"), column, keys, mode=mode)
    dim = _dedup(exploded.select(*dim_cols), "id", reproducible)
    dim = with_audit(dim).withColumn("gender", gender_label(F.col("gender")))
    bridge = exploded.select("movie_id", F.col("id").alias(ref))
    return dim, bridge


def cast(credits: DataFrame, reproducible: bool | str = False, mode: str = "strict"):
    """``dim_cast`` and ``movie_cast`` (the role is not kept)."""
    return _people(credits, "cast", CAST_KEYS, ["id", "name", "character", "gender"], "cast_id", reproducible, mode)


def crew(credits: DataFrame, reproducible: bool | str = False, mode: str = "strict"):
    """``dim_crew`` and ``movie_crew``."""
    return _people(credits, "crew", CREW_KEYS, ["id", "name", "department", "gender", "job"], "crew_id", reproducible, mode)


# Movie list columns -> (kind, key of the id, id type).
MOVIE_LISTS = {
    "genres": ("genre", "id", "bigint"),
    "production_companies": ("company", "id", "bigint"),
    "production_countries": ("country", "iso_3166_1", None),
    "spoken_languages": ("language", "iso_639_1", None),
}


#: Movie list column -> its dimension, its bridge and the bridge's reference.
LIST_TABLES = {
    "genres": ("dim_genres", "movie_genres", "genre_id"),
    "production_companies": ("dim_companies", "movie_production_companies", "company_id"),
    "production_countries": ("dim_countries", "movie_countries", "country_code"),
    "spoken_languages": ("dim_languages", "movie_languages", "language_code"),
}


def _with_losses(rows: DataFrame, parsed: dict[str, F.Column], lists: F.Column, losses: Observation | None) -> DataFrame:
    """``movie_id`` and ``__nm_e``, the elements of all lists; ``losses`` counts per
    list column, while the rows pass, the texts that are there but do not parse
    (all of their elements are lost, Q6).  Callers use ``explode_outer`` and drop its empty
    row: for ``explode`` Spark filters on the list's size first, and parses it twice."""
    if losses is None:
        return rows.select("movie_id", lists.alias("__nm_e"))
    # the parse comes first in both expressions, so that it is worked out once
    lost = [(p.isNull() & F.col(c).isNotNull() & (F.trim(F.col(c)) != "")).alias(f"__nm_lost_{c}") for c, p in parsed.items()]
    return rows.select("movie_id", lists.alias("__nm_e"), *lost).observe(losses, *[F.count_if(f"__nm_lost_{c}").alias(c) for c in parsed])


def _refused(raw: dict[str, tuple[F.Column, str | None]]) -> F.Column:
    """Reason why an element cannot be stored: texts that fail their cast (K4)."""
    reasons = [F.when(v.isNotNull() & safe_cast(v, t).isNull(), F.concat(F.lit(f"{name}: not {t}: "), v)) for name, (v, t) in raw.items() if t]
    return F.nullif(F.concat_ws("; ", *reasons), F.lit("")) if reasons else F.lit(None).cast("string")


def movie_elements(movies: DataFrame, mode: str = "strict", losses: Observation | None = None, lists: Sequence[str] | None = None) -> DataFrame:
    """All four movie list columns (or ``lists``, some of them) in one pass: ``(movie_id,
    kind, key, name, bad)``, ``key`` still text, ``bad`` why it cannot be stored.  One
    generator over the concatenated lists, so the eight genre/company/country/language
    tables can share one parse."""
    wanted = {c: spec for c, spec in MOVIE_LISTS.items() if lists is None or c in lists}
    empty = F.array().cast("array<struct<kind:string,key:string,name:string>>")
    every = []
    def element(kind: str, id_key: str):
        return lambda m: F.struct(F.lit(kind).alias("kind"), m.getItem(id_key).alias("key"), m.getItem("name").alias("name"))

    parsed = {column: parse_elements(F.col(column), mode) for column in wanted}
    for column, (kind, id_key, _) in wanted.items():
        every.append(F.coalesce(F.transform(parsed[column], element(kind, id_key)), empty))
    rows = _with_losses(movies.select(F.col("id").alias("movie_id"), *wanted), parsed, F.concat(*every), losses)
    rows = rows.select("movie_id", F.explode_outer("__nm_e").alias("e")).where("e IS NOT NULL").select("movie_id", "e.kind", "e.key", "e.name")
    bad = None
    for kind, id_key, id_type in MOVIE_LISTS.values():
        if id_type:
            why = _refused({id_key: (F.col("key"), id_type)})
            bad = F.when(F.col("kind") == kind, why) if bad is None else bad.when(F.col("kind") == kind, why)
    return rows.withColumn("bad", bad)


def movie_list_tables(elements: DataFrame, reproducible: bool | str = False, sort_languages: bool = True, lists: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The eight genre/company/country/language tables (of ``lists`` only, if given) from ``movie_elements``
    rows that can be stored: otherwise same result as ``genres``, ``companies``, ``countries``, ``languages``."""
    out = {}
    for column, (kind, _, id_type) in MOVIE_LISTS.items():
        if lists is not None and column not in lists:
            continue
        dim_name, bridge_name, ref = LIST_TABLES[column]
        rows = elements.filter((F.col("kind") == kind) & F.col("bad").isNull())
        key = safe_cast(F.col("key"), id_type) if id_type else F.col("key")
        rows = rows.select("movie_id", key.alias(ref), F.col("name").alias("__nm_name"))
        dim = _dedup(rows.select(ref, "__nm_name"), ref, reproducible)
        if kind == "language":
            dim = dim.withColumnsRenamed({ref: "iso_code", "__nm_name": "original_name"})
            dim = with_language_name(dim, "iso_code", "name").select("iso_code", "name", "original_name")
            dim = with_audit(dim)
            if sort_languages:
                dim = dim.orderBy("iso_code")
        else:
            dim = with_audit(dim.withColumnsRenamed({ref: "iso_code" if kind == "country" else "id", "__nm_name": "name"}))
        out[dim_name] = dim
        out[bridge_name] = rows.select("movie_id", ref)
    return out


def credit_people(credits: DataFrame, mode: str = "strict", losses: Observation | None = None, roles: Sequence[str] = ("cast", "crew")) -> DataFrame:
    """Cast and crew (or ``roles``, one of them) of every credits row in one pass: one row per element,
    ``role`` = ``cast`` or ``crew``.

    Both lists are parsed once and exploded by a single generator, so the
    four cast/crew tables can come from one scan of the (large) credits
    files instead of four.  Element semantics are those of ``explode_json``.
    """
    parsed = {column: parse_elements(F.col(column), mode) for column in roles}

    def tagged(role: str):
        return F.transform(parsed[role], lambda m: F.struct(F.lit(role).alias("role"), m.alias("m")))

    empty = F.array().cast("array<struct<role:string,m:map<string,string>>>")
    both = F.concat(*[F.coalesce(tagged(role), empty) for role in roles])
    rows = _with_losses(credits.select(F.col("id").alias("movie_id"), *roles), parsed, both, losses)
    rows = rows.select("movie_id", F.explode_outer("__nm_e").alias("p")).where("p IS NOT NULL")
    m = F.col("p.m")
    return rows.select(
        "movie_id",
        F.col("p.role").alias("role"),
        safe_cast(m.getItem("id"), "bigint").alias("id"),
        m.getItem("name").alias("name"),
        m.getItem("character").alias("character"),
        safe_cast(m.getItem("gender"), "int").alias("gender"),
        m.getItem("department").alias("department"),
        m.getItem("job").alias("job"),
        _refused({"id": (m.getItem("id"), "bigint"), "gender": (m.getItem("gender"), "int")}).alias("bad"),
    )


def people_tables(people: DataFrame, reproducible: bool | str = False) -> dict[str, DataFrame]:
    """T8/T9 from ``credit_people`` rows: same result as ``cast`` and ``crew``, without
    the columns that ``people`` does not have."""
    out = {}
    for role, dim_cols, ref in [
        ("cast", ["id", "name", "character", "gender"], "cast_id"),
        ("crew", ["id", "name", "department", "gender", "job"], "crew_id"),
    ]:
        rows = people.filter((F.col("role") == role) & F.col("bad").isNull())
        dim = _dedup(rows.select(*[c for c in dim_cols if c in people.columns]), "id", reproducible)
        out[f"dim_{role}"] = with_audit(dim).withColumn("gender", gender_label(F.col("gender")))
        out[f"movie_{role}"] = rows.select("movie_id", F.col("id").alias(ref))
    return out


def keyword_elements(raw_keywords: DataFrame, mode: str = "strict", losses: Observation | None = None) -> DataFrame:
    """``(movie_id, id, name, bad)`` per keyword element, parsed once."""
    parsed = parse_elements(F.col("keywords"), mode)
    m = F.col("m")
    held = F.transform(parsed, lambda x: F.struct(x.alias("m")))  # an element that is no object is a null map
    rows = _with_losses(raw_keywords.select(F.col("id").alias("movie_id"), "keywords"), {"keywords": parsed}, held, losses)
    rows = rows.select("movie_id", F.explode_outer("__nm_e").alias("e")).where("e IS NOT NULL").select("movie_id", "e.m")
    return rows.select("movie_id", safe_cast(m.getItem("id"), "bigint").alias("id"), m.getItem("name").alias("name"), _refused({"id": (m.getItem("id"), "bigint")}).alias("bad"))


def keyword_tables(elements: DataFrame, reproducible: bool | str = False) -> dict[str, DataFrame]:
    """T10 from ``keyword_elements`` rows: same result as ``keywords``."""
    good = elements.filter(F.col("bad").isNull())
    return {
        "dim_keywords": with_audit(_dedup(good.select("id", "name"), "id", reproducible)),
        "movie_keywords": good.select("movie_id", F.col("id").alias("keyword_id")),
    }


def keywords(raw_keywords: DataFrame, reproducible: bool | str = False, mode: str = "strict"):
    """``dim_keywords`` and ``movie_keywords``."""
    exploded = explode_json(raw_keywords.withColumnRenamed("id", "movie_id"), "keywords", KEYWORD_KEYS, mode=mode)
    dim = with_audit(_dedup(exploded.select("id", "name"), "id", reproducible))
    bridge = exploded.select("movie_id", F.col("id").alias("keyword_id"))
    return dim, bridge


def fact_rating(ratings: DataFrame) -> DataFrame:
    """count/avg/min/max of the rating per movie."""
    stats = ratings.groupBy("movieId").agg(
        F.count("userId").alias("ratings_count"),
        F.avg("rating").alias("ratings_average"),
        F.min("rating").cast("double").alias("min_rate"),
        F.max("rating").cast("double").alias("max_rate"),
    )
    return with_audit(stats).withColumnRenamed("movieId", "movie_id")


def rating_stats(ratings: DataFrame) -> DataFrame:
    """T11 with the sum and number of ratings, so that batches can be merged."""
    return ratings.groupBy(F.col("movieId").alias("movie_id")).agg(
        F.count("userId").alias("ratings_count"),
        F.sum(F.col("rating").cast("double")).alias("rating_total"),
        F.count("rating").alias("rating_values"),
        F.min("rating").cast("double").alias("min_rate"),
        F.max("rating").cast("double").alias("max_rate"),
    )


def build_warehouse(
    sources: Mapping[str, DataFrame],
    reproducible: bool | str = False,
    mode: str = "strict",
    staged: DataFrame | None = None,
    people: DataFrame | None = None,
    elements: DataFrame | None = None,
    keyword_rows: DataFrame | None = None,
    lists: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """All 17 target frames from the four raw source frames.  ``lists``: the movie list
    columns whose tables are built (all, if not given).

    ``staged`` lets the caller pass a materialized ``staged_movies`` so the
    ten movie outputs share one scan; ``elements`` a materialized
    ``movie_elements`` of it for the eight list outputs, and ``people`` a
    materialized ``credit_people`` for the four cast/crew outputs.
    """
    out: dict[str, DataFrame] = {}
    if "movies_metadata" in sources or staged is not None:
        movies = staged if staged is not None else staged_movies(sources["movies_metadata"], reproducible)
        out["dim_movies"] = dim_movies(movies)
        out["fact_movie_sales"] = fact_movie_sales(movies)
        if lists is None or lists:
            elements = elements if elements is not None else movie_elements(movies, mode, lists=lists)
            out.update(movie_list_tables(elements, reproducible, reproducible != MERGED, lists))
    if people is None and "credits" in sources:
        people = credit_people(sources["credits"], mode)
    if people is not None:
        out.update(people_tables(people, reproducible))
    if keyword_rows is None and "keywords" in sources:
        keyword_rows = keyword_elements(sources["keywords"], mode)
    if keyword_rows is not None:
        out.update(keyword_tables(keyword_rows, reproducible))
    if "ratings" in sources:
        out["fact_rating"] = fact_rating(sources["ratings"])
    return out
