"""A movie-style catalog derived from the supplied TPC-H-like tables.

The toolkit's inputs are four CSV families with nested text columns
(movies, credits, keywords, ratings).  The benchmark data is relational, so
this job re-expresses it in that shape; every row derives from the given
tables, so the work grows with them.

Stand-ins (all derived, never sampled):

==============  ==========================================================
movie           an order (``id`` = ``o_orderkey``)
release date    ``o_orderdate``; revenue = ``o_totalprice``
genre           ``p_type`` of the order's parts; id = smallest partkey of
                that type
company         ``p_brand`` of the order's parts; id = the brand number
country         nation of the order's suppliers; code = key as two digits
language        region of the order's suppliers, through ``REGION_LANGUAGE``
cast            the order's suppliers, one element per lineitem
crew, keyword   the order's parts, one element per lineitem
rating          one per lineitem: user = supplier, 1-5 from the quantity
==============  ==========================================================

Movies carry sets over small domains (types, brands, nations, regions), so
their lists are bounded by the domain size however skewed an order is.
Credits and keywords carry one element per lineitem, all of a movie in one list;
a movie of more than ``CHUNK`` lineitems is cut into several rows of bounded size,
which the pipeline treats as a bag, exactly as the original did with
repeated credits rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nested import nest_json, scan_chunks, split_large
from ..functions.values import values_frame
from ..schemas import SOURCE_SCHEMAS
from ..sources import read_parquet_table

# Region -> (ISO 639-1 code, name of the language in itself).
REGION_LANGUAGE = {
    "AFRICA": ("sw", "Kiswahili"),
    "AMERICA": ("en", "English"),
    "ASIA": ("zh", "中文"),
    "EUROPE": ("de", "Deutsch"),
    "MIDDLE EAST": ("ar", "العربية"),
}

CHUNK = 1000  # most elements one credits/keywords row carries


def load_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    names = names or ["region", "nation", "supplier", "part", "orders", "lineitem"]
    return {n: read_parquet_table(spark, sf_dir, n) for n in names}


def region_languages(spark: SparkSession) -> DataFrame:
    """The mapping as a SQL ``VALUES`` relation, which carries size
    statistics (an RDD-backed frame would look unboundedly large to the
    planner and block broadcast joins downstream)."""
    return values_frame(spark, [(r, code, native) for r, (code, native) in REGION_LANGUAGE.items()], ["r_name", "lang_code", "lang_native"])


def _supplier_geo(t: Mapping[str, DataFrame]) -> DataFrame:
    """supplier -> nation, country code, region language (nation/region are
    fixed-size tables of 25 and 5 rows)."""
    spark = t["supplier"].sparkSession
    nation = t["nation"].join(F.broadcast(t["region"]), F.col("n_regionkey") == F.col("r_regionkey"))
    nation = nation.join(F.broadcast(region_languages(spark)), "r_name", "left")
    nation = nation.select(
        "n_nationkey",
        "n_name",
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("country_code"),
        "lang_code",
        "lang_native",
    )
    return t["supplier"].join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))


def _part_genre(t: Mapping[str, DataFrame], how: str = "inner") -> DataFrame:
    part = t["part"]
    genre_ids = part.groupBy("p_type").agg(F.min("p_partkey").cast("long").alias("genre_id"))
    brand_no = F.expr("try_cast(substr(p_brand, 7) AS INT)")
    return part.join(genre_ids, "p_type", how).select(
        "p_partkey", "p_name", "p_type", "p_brand", "p_size", "genre_id", brand_no.alias("brand_id")
    )


def _chunked(lineitem: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """lineitem with ``__nm_chunk``: null but for orders of more than ``chunk``
    lines, whose lists are cut; assigned on the scan, so it is stable under task
    retries."""
    return split_large(scan_chunks(lineitem, chunk), "l_orderkey", chunk)


def _lines(t: Mapping[str, DataFrame], chunk: int | None = None) -> DataFrame:
    """lineitem with its part and supplier attributes (and chunk numbers, if asked for); ``t["lines"]``
    if they are stored."""
    if "lines" in t:
        return t["lines"]
    li = _chunked(t["lineitem"], chunk) if chunk else t["lineitem"].withColumn("__nm_chunk", F.lit(None))
    li = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_shipdate", "__nm_chunk"
    )
    li = li.join(_part_genre(t), F.col("l_partkey") == F.col("p_partkey"))
    return li.join(_supplier_geo(t), F.col("l_suppkey") == F.col("s_suppkey"))


def part_lines(t: Mapping[str, DataFrame], chunk: int = CHUNK) -> DataFrame:
    """Every lineitem that has a part, with its chunk number and the part's attributes; to be
    stored as ``t["part_lines"]`` where more than one frame is derived."""
    li = _chunked(t["lineitem"], chunk).select("l_orderkey", "l_partkey", "l_suppkey", "l_discount", "__nm_chunk")
    return li.join(_part_genre(t, "left"), F.col("l_partkey") == F.col("p_partkey")).drop("l_partkey")


def supplied_lines(t: Mapping[str, DataFrame]) -> DataFrame:
    """``part_lines`` that have a part type and a supplier, with the supplier's attributes; to be
    stored as ``t["lines"]``, which movies and credits read then."""
    li = t["part_lines"].where("p_type IS NOT NULL").join(_supplier_geo(t), F.col("l_suppkey") == F.col("s_suppkey"))
    geo = ["s_suppkey", "s_name", "s_nationkey", "country_code", "n_name", "lang_code", "lang_native"]
    return li.select(*[c for c in t["part_lines"].columns if c != "l_suppkey"], *geo)


def _json_set(*fields) -> F.Column:
    return F.to_json(F.sort_array(F.collect_set(F.struct(*fields))))


def movies_frame(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row per order, in the declared movies column order."""
    per_order = _lines(t).groupBy("l_orderkey").agg(
        _json_set(F.col("genre_id").alias("id"), F.col("p_type").alias("name")).alias("genres"),
        _json_set(F.col("brand_id").alias("id"), F.col("p_brand").alias("name")).alias("production_companies"),
        _json_set(F.col("country_code").alias("iso_3166_1"), F.col("n_name").alias("name")).alias("production_countries"),
        _json_set(F.col("lang_code").alias("iso_639_1"), F.col("lang_native").alias("name")).alias("spoken_languages"),
        F.min("lang_code").alias("original_language"),
        F.count(F.lit(1)).cast("int").alias("lines"),
        (F.max("l_discount") * 100).cast("float").alias("vote_average"),
    )
    o = t["orders"]
    m = o.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    key = F.col("o_orderkey")
    cols = {
        "adult": F.col("o_orderstatus") == "P",
        "belongs_to_collection": F.concat(F.lit('{"id": '), F.col("o_custkey").cast("string"), F.lit("}")),
        "budget": F.col("o_totalprice") / 2,
        "genres": F.col("genres"),
        "homepage": F.lit(None).cast("string"),
        "id": key.cast("long"),
        "imdb_id": F.concat(F.lit("tt"), F.lpad(key.cast("string"), 7, "0")),
        "original_language": F.col("original_language"),
        "original_title": F.concat(F.lit('Order "'), key.cast("string"), F.lit('", '), F.col("o_orderpriority")),
        "overview": F.concat(F.lit("Priority "), F.col("o_orderpriority"), F.lit(", status "), F.col("o_orderstatus")),
        "popularity": (F.col("o_totalprice") / 1000).cast("float"),
        "poster_path": F.lit(None).cast("string"),
        "production_companies": F.col("production_companies"),
        "production_countries": F.col("production_countries"),
        "release_date": F.to_date(F.col("o_orderdate")),
        "revenue": F.col("o_totalprice"),
        "runtime": F.col("lines"),
        "spoken_languages": F.col("spoken_languages"),
        "status": F.col("o_orderstatus"),
        "tagline": F.lit(None).cast("string"),
        "title": F.concat(F.lit("Order #"), key.cast("string")),
        "video": F.col("o_orderpriority") == "1-URGENT",
        "vote_average": F.col("vote_average"),
        "vote_count": F.col("lines"),
    }
    schema = SOURCE_SCHEMAS["movies_metadata"]
    # try_cast: a value outside its declared type becomes null, exactly as a CSV
    # scan with the declared schema would read it (keys are long and fit).
    return m.select(*[cols[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields])


def credits_frame(t: Mapping[str, DataFrame], chunk: int = CHUNK) -> DataFrame:
    """``(cast, crew, id)``: suppliers as cast, parts as crew, per lineitem."""
    lines = _lines(t, chunk)
    cast_el = {
        "id": F.col("s_suppkey"),
        "name": F.col("s_name"),
        "character": F.concat(F.lit("Agent of "), F.col("n_name")),
        "gender": F.floor(F.col("s_nationkey") / 7).cast("int"),
    }
    crew_el = {
        "id": F.col("p_partkey"),
        "name": F.col("p_name"),
        "department": F.col("p_type"),
        "gender": F.floor(F.col("p_size") / 13).cast("int"),
        "job": F.col("p_brand"),
    }
    nested = nest_json(lines, ["l_orderkey"], cast_el, "cast", chunk, extra={"crew": crew_el}, chunk="__nm_chunk")
    return nested.select("cast", "crew", F.col("l_orderkey").cast("long").alias("id"))


def keywords_frame(t: Mapping[str, DataFrame], chunk: int = CHUNK) -> DataFrame:
    """``(id, keywords)``: the order's part names, per lineitem."""
    if "part_lines" in t:
        li = t["part_lines"]
    else:
        li = _chunked(t["lineitem"], chunk).select("l_orderkey", "l_partkey", "__nm_chunk")
        li = li.join(t["part"].select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    nested = nest_json(li, ["l_orderkey"], {"id": F.col("p_partkey"), "name": F.col("p_name")}, "keywords", chunk, chunk="__nm_chunk")
    return nested.select(F.col("l_orderkey").cast("long").alias("id"), "keywords")


def ratings_frame(t: Mapping[str, DataFrame]) -> DataFrame:
    """One rating per lineitem, 1-5 from the quantity; epoch-second time."""
    li = t["lineitem"]
    return li.select(
        F.col("l_suppkey").cast("long").alias("userId"),
        F.col("l_orderkey").cast("long").alias("movieId"),
        F.ceil(F.col("l_quantity") / 10).cast("float").alias("rating"),
        (F.unix_date(F.to_date(F.col("l_shipdate"))) * 86400).cast("long").alias("timestamp"),
    )


def derive_catalog(spark: SparkSession, sf_dir: str, t: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The four raw source frames, typed like a CSV scan of them; of the tables ``t``, if given."""
    t = load_tables(spark, sf_dir) if t is None else t
    return {
        "movies_metadata": movies_frame(t),
        "credits": credits_frame(t),
        "keywords": keywords_frame(t),
        "ratings": ratings_frame(t),
    }
