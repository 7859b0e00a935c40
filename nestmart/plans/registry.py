"""Runnable checks of every operator on the supplied tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame computed from the
whole supplied tables (or from data Spark derives from them).  ``oracle.py``
holds the matching SQL.  Scratch files go to a new folder under the shared
checkpoint directory.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from .. import operators as ops
from ..schemas import TABLES
from ..session import remove_scratch, scratch_path, shuffles_removed
from ..sinks import ledger
from ..sinks import warehouse as sink
from ..sources import TABLE_NAMES, read_csv, read_parquet_table, read_prefix, register_view, write_csv
from ..streaming.ingest import process_batch, run_ingest
from . import catalog, load, quality, questions, tables

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the question analogues.
B1_YEAR, B1_LANGUAGE = 2000, "en"
B2_FIRST, B2_LAST = "1995-01-01", "1997-12-31"
B3_COUNTRY, B3_GENRE, B3_FIRST, B3_LAST = "07", "PROMO", "1996-01-01", "1999-12-31"
B4_GENRE, B4_YEAR = "PROMO", 2000
B5_FIRST, B5_LAST = "1997-01-01", "2000-12-31"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet_table(spark, sf_dir, name)


def _staged(spark: SparkSession, df: DataFrame, tag: str, paths: list[str] | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back; its shuffle files go with the
    write.  The folder is added to ``paths``."""
    path = scratch_path(spark, tag)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _with_lines(spark: SparkSession, t: dict[str, DataFrame], paths: list[str]) -> dict[str, DataFrame]:
    """The tables with lineitem joined to parts, and to suppliers, once for all frames derived from them."""
    t = t | {"part_lines": _staged(spark, catalog.part_lines(t), "part-lines", paths)}
    return t | {"lines": _staged(spark, catalog.supplied_lines(t), "lines", paths)}


def _landed(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """The four source families as landed files; their folders."""
    paths: list[str] = []
    t = _with_lines(spark, catalog.load_tables(spark, sf_dir), paths)
    prefixes = load.write_sources(catalog.derive_catalog(spark, sf_dir, t), f"{root}/landing")
    remove_scratch(spark, *paths)
    return prefixes


def _warehouse(spark: SparkSession, sf_dir: str, lists=tuple(tables.MOVIE_LISTS), families=load.FAMILIES) -> dict[str, DataFrame]:
    """The frames of ``families`` built from the derived catalog.

    As in a load, movies are derived and deduplicated once, and nested lists parsed once:
    both are staged in the shared folder and every table that comes from them reads that.  ``lists``
    are the movie lists that are asked for; of cast and crew the numbers and
    genders are kept, which is what the questions and the gate read.
    """
    t = catalog.load_tables(spark, sf_dir)
    staged = {}
    sources = {}
    paths: list[str] = []
    if len({"movies_metadata", "credits", "keywords"}.intersection(families)) > 1:
        t = _with_lines(spark, t, paths)
    if "movies_metadata" in families:
        movies = tables.staged_movies(catalog.movies_frame(t))
        kept = dict.fromkeys([*tables.DIM_MOVIES_COLUMNS, *tables.SALES_COLUMNS, *lists, "id"])
        movies = staged["staged"] = _staged(spark, movies.select(*[c for c in kept if c != "movie_id"]), "warehouse-movies")
        if lists:
            staged["elements"] = _staged(spark, tables.movie_elements(movies, lists=lists), "warehouse-elements")
    if "credits" in families:
        people = tables.credit_people(catalog.credits_frame(t))
        staged["people"] = _staged(spark, people.select("movie_id", "role", "id", "gender", "bad"), "warehouse-people")
    if "keywords" in families:
        staged["keyword_rows"] = _staged(spark, tables.keyword_elements(catalog.keywords_frame(t)), "warehouse-keywords")
    remove_scratch(spark, *paths)
    if "ratings" in families:
        sources["ratings"] = catalog.ratings_frame(t)
    return tables.build_warehouse(sources, **staged, lists=lists)


def _movie_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``dim_movies`` and ``fact_movie_sales``, with no list parsed."""
    return tables.build_warehouse({"movies_metadata": catalog.movies_frame(catalog.load_tables(spark, sf_dir))}, lists=())


def _no_audit(df: DataFrame) -> DataFrame:
    return df.drop("last_updated")


def _database(spark: SparkSession, tag: str) -> tuple[str, str]:
    location = scratch_path(spark, tag)
    name = "nm_" + location.rsplit("-", 1)[-1][:16]
    return name, location


# --- scans and sources ----------------------------------------------------
def csv_scan(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    path = scratch_path(spark, "csv-scan")
    write_csv(orders, path, quoted=True)
    return read_csv(spark, path, orders.schema, quoted=True)


def csv_prefix_union(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    root = scratch_path(spark, "csv-prefix")
    write_csv(orders.filter(F.col("o_orderstatus") == "F"), f"{root}/ord", quoted=False)
    write_csv(orders.filter(F.col("o_orderstatus") != "F"), f"{root}/ord_extra", quoted=False)
    both = read_prefix(spark, f"{root}/ord", orders.schema, quoted=False)
    none = read_prefix(spark, f"{root}/missing", orders.schema, quoted=False)
    return both.unionByName(none)


def csv_quoted_text(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_path(spark, "csv-text")
    write_csv(docs, path, quoted=True)
    return read_csv(spark, path, docs.schema, quoted=True, multi_line=True)


def sql_view(spark, sf_dir):
    register_view(_t(spark, sf_dir, "customer"), "nm_customer")
    return spark.sql(
        "SELECT c_custkey, c_name, c_acctbal, c_mktsegment IS NULL AS segment_missing "
        "FROM nm_customer WHERE c_acctbal > 0 AND c_name IS NOT NULL"
    )


# --- projections and filters ----------------------------------------------
def project_rename_audit(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    renamed = orders.withColumnsRenamed({"o_orderkey": "order_id", "o_totalprice": "revenue"})
    audited = fn.with_audit(renamed.withColumn("release_date", F.to_date("o_orderdate")))
    return audited.drop("o_orderdate", "o_orderstatus", "last_updated")


def filter_not_null_fill(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select(
        "c_custkey",
        F.nullif(F.col("c_nationkey"), F.lit(0)).alias("c_nationkey"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
    )
    return fn.fill_numeric_nulls(ops.keep_not_null(c, "c_nationkey"))


def filter_null_safe_neq(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.nullif(F.col("lang"), F.lit("fr")).alias("lang"))
    return ops.not_equal_keep_null(docs, "lang", "en")


def date_range(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return ops.in_date_range(o, "o_orderdate", "1996-03-01", "1998-10-31").select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_date")
    )


def year_filter(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return ops.in_year(o, "o_orderdate", 1997).select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))


# --- nested text ----------------------------------------------------------
def json_key_lookup(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "props")
    k = fn.safe_cast(fn.parse_dict(F.col("props")).getItem("k"), "int")
    return ev.select("event_id", k.alias("k"))


def json_bridge(spark, sf_dir):
    t = catalog.load_tables(spark, sf_dir, ["lineitem", "part"])
    _, bridge = tables.keywords(catalog.keywords_frame(t))
    return bridge


def json_dim(spark, sf_dir):
    t = catalog.load_tables(spark, sf_dir)
    dim, _ = tables.cast(catalog.credits_frame(t))
    return _no_audit(dim)


def _customers_as_literals(spark, sf_dir, mode):
    """Customers rendered as Python-literal text, then exploded in ``mode``."""
    c = _t(spark, sf_dir, "customer")
    segment = F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("None")).otherwise(
        F.concat(F.lit("'"), F.col("c_mktsegment"), F.lit("'"))
    )
    vip = F.when(F.col("c_acctbal") > 5000, F.lit("True")).otherwise(F.lit("False"))
    text = F.concat(
        F.lit("[{'id': "), F.col("c_custkey").cast("string"),
        F.lit(", 'name': '"), F.col("c_name"),
        F.lit("', 'segment': "), segment,
        F.lit(", 'vip': "), vip,
        F.lit(", 'note': 'Yes, None, maybe', 'tag': 'a\\xa0b'}]"),
    )
    nested = c.select(text.alias("customers"))
    keys = [fn.Key("id", "id", "long"), fn.Key("name", "name"), fn.Key("segment", "segment"),
            fn.Key("vip", "vip"), fn.Key("note", "note"), fn.Key("tag", "tag")]
    return fn.explode_json(nested, "customers", keys, mode=mode).drop("customers")


def json_pyliteral(spark, sf_dir):
    """P5 with the JVM-side regex repair."""
    return _customers_as_literals(spark, sf_dir, "pyliteral")


def json_python_literal(spark, sf_dir):
    """P5 with exact ``ast.literal_eval`` decoding (Arrow pandas UDF) of the
    rows strict parsing rejects."""
    return _customers_as_literals(spark, sf_dir, "python")


def movies_staged(spark, sf_dir):
    raw = catalog.derive_catalog(spark, sf_dir)["movies_metadata"]
    staged = tables.staged_movies(raw)
    return staged.select("id", "title", "original_title", "release_date", "revenue", "budget", "vote_average", "vote_count", "status", "adult", "video")


def fact_sales(spark, sf_dir):
    raw = catalog.derive_catalog(spark, sf_dir)["movies_metadata"]
    return _no_audit(tables.fact_movie_sales(tables.staged_movies(raw)))


def language_dim(spark, sf_dir):
    raw = catalog.derive_catalog(spark, sf_dir)["movies_metadata"]
    dim, _ = tables.languages(tables.staged_movies(raw))
    return _no_audit(dim)


def dedup_ordered(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    order = [c for c in li.columns if c != "l_orderkey"]
    return ops.dedup_by_key(li, ["l_orderkey"], order_by=order)


def dedup_latest(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return ops.dedup_by_key(o, ["o_custkey"], order_by=["o_orderdate", "o_orderkey"], ascending=False)


# --- scalar functions -------------------------------------------------------
def code_label(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey", fn.gender_label(F.col("c_nationkey")).alias("label"))


def lookup_name(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang")
    return fn.with_language_name(docs, "lang", "language")


# --- aggregates, counts, ordering -----------------------------------------
def group_stats(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return ops.group_stats(li, "l_partkey", "l_quantity", names={"count": "n", "avg": "avg_qty", "min": "min_qty", "max": "max_qty"})


def row_counts(spark, sf_dir):
    return ops.row_counts({n: _t(spark, sf_dir, n) for n in TABLE_NAMES})


def profile(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    c = c.withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    return quality.profile(c, "customer")


def sorted_orders(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ops.sort_by(o, ["o_totalprice", "o_orderkey"], descending=True)


def top_revenue(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ops.preview(ops.sort_by(o, ["o_totalprice", "o_orderkey"], descending=True), 10)


def surrogate_key(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return ops.with_dense_id(o, ["o_orderdate", "o_orderkey"], "id").select("id", "o_orderkey")


def surrogate_key_payload(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return ops.with_dense_id(li.repartition(4), ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"], "id")


def shifted_keys(spark, sf_dir):
    """Movie ids beyond 32 bits: every movie and its ratings must stay."""
    t = {n: _t(spark, sf_dir, n) for n in ("nation", "region", "supplier", "part", "orders", "lineitem")}
    t["orders"] = t["orders"].withColumn("o_orderkey", F.col("o_orderkey") + F.lit(1 << 33))
    t["lineitem"] = t["lineitem"].withColumn("l_orderkey", F.col("l_orderkey") + F.lit(1 << 33))
    movies = tables.staged_movies(catalog.movies_frame(t)).select(F.col("id").alias("movie_id"))
    ratings = tables.fact_rating(catalog.ratings_frame(t)).select("movie_id", "ratings_count")
    return movies.join(ratings, "movie_id", "left")


def distinct_count(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return ops.distinct_count(li, "l_partkey", "parts")


# --- sinks ----------------------------------------------------------------
def append_read_back(spark, sf_dir):
    db, location = _database(spark, "append")
    sink.create_all(spark, db, location, ["movie_genres"])
    raw = catalog.derive_catalog(spark, sf_dir)["movies_metadata"]
    _, bridge = tables.genres(tables.staged_movies(raw))
    sink.write_table(bridge, db, "movie_genres", "append")
    sink.write_table(bridge, db, "movie_genres", "append")
    stored = spark.table(f"{db}.movie_genres")
    return stored.select("movie_id", "genre_id")


def surrogate_ids_unique(spark, sf_dir):
    db, location = _database(spark, "ids")
    sink.create_all(spark, db, location, ["movie_cast"])
    _, bridge = tables.cast(catalog.credits_frame(catalog.load_tables(spark, sf_dir)))
    sink.write_table(bridge, db, "movie_cast", "append")
    sink.write_table(bridge, db, "movie_cast", "append")
    stored = spark.table(f"{db}.movie_cast")
    return stored.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"), F.min("id").alias("first_id"))


def target_reset(spark, sf_dir):
    db, location = _database(spark, "reset")
    sink.create_all(spark, db, location)
    sink.drop_all(spark, db)
    sink.create_all(spark, db, location)
    ratings = catalog.ratings_frame(catalog.load_tables(spark, sf_dir, ["lineitem"]))
    sink.write_table(tables.fact_rating(ratings), db, "fact_rating", "overwrite")
    return _no_audit(spark.table(f"{db}.fact_rating"))


# --- quality ----------------------------------------------------------------
def pk_violations(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def fk_orphans(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parents = ops.in_date_range(_t(spark, sf_dir, "orders"), "o_orderdate", "1995-01-01", "1999-12-31")
    return ops.anti_join(li, parents, ["l_orderkey"], ["o_orderkey"])


def orphan_count(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    parents = ops.in_date_range(_t(spark, sf_dir, "orders"), "o_orderdate", "1995-01-01", "1999-12-31")
    return quality.orphan_rule(li, "lineitem", "l_orderkey", parents, "o_orderkey")


def null_check(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    w = _warehouse(spark, sf_dir, ["spoken_languages"], ["movies_metadata"])
    return (
        quality.null_rule(w["dim_movies"], "dim_movies", "id")
        .unionByName(quality.null_rule(w["dim_languages"], "dim_languages", "name"))
        .unionByName(quality.null_rule(c, "customer", "c_acctbal"))
    )


def positive_check(spark, sf_dir):
    w = _movie_tables(spark, sf_dir)
    c = _t(spark, sf_dir, "customer")
    return quality.some_positive_rule(w["fact_movie_sales"], "fact_movie_sales", "revenue").unionByName(
        quality.some_positive_rule(c.filter(F.col("c_acctbal") < 0), "customer", "c_acctbal")
    )


def _conformed(w: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Frames as stored: registry types, bridge surrogate ids."""
    def there(name: str):
        t = TABLES[name]
        return replace(t, columns=type(t.columns)(c for c in t.columns if c.name in w[name].columns or c.name == t.identity))

    return {name: sink.conform(df, there(name)) for name, df in w.items()}


def quality_gate(spark, sf_dir):
    return quality.gate(_conformed(_warehouse(spark, sf_dir)))


def quality_gate_defects(spark, sf_dir):
    """Gate over a partial load: ``dim_movies`` holds only movies released
    before 2000, so every movie reference to a later movie is an orphan."""
    w = _conformed(_warehouse(spark, sf_dir))
    w["dim_movies"] = w["dim_movies"].filter(F.col("release_date") < F.lit("2000-01-01").cast("date"))
    return quality.gate(w)


# --- questions and loads ----------------------------------------------------
def question_b1(spark, sf_dir):
    return questions.question_b1(_warehouse(spark, sf_dir, ["spoken_languages"], ["movies_metadata"]), B1_YEAR, B1_LANGUAGE)


def question_b1_original(spark, sf_dir):
    raw = catalog.derive_catalog(spark, sf_dir)["movies_metadata"]
    return questions.question_b1_original(tables.staged_movies(raw), B1_YEAR, B1_LANGUAGE)


def question_b2(spark, sf_dir):
    return questions.question_b2(_warehouse(spark, sf_dir, families=["credits"]) | _movie_tables(spark, sf_dir), B2_FIRST, B2_LAST)


def question_b3(spark, sf_dir):
    return questions.question_b3(_warehouse(spark, sf_dir, ["production_countries", "genres"], ["movies_metadata"]), B3_COUNTRY, B3_GENRE, B3_FIRST, B3_LAST)


def question_b4(spark, sf_dir):
    return questions.question_b4(_warehouse(spark, sf_dir, ["genres"], ["movies_metadata"]), B4_GENRE, B4_YEAR)


def question_b5(spark, sf_dir):
    return questions.question_b5(_warehouse(spark, sf_dir, ["production_companies"], ["movies_metadata"]), B5_FIRST, B5_LAST)


def star_load(spark, sf_dir):
    return ops.row_counts(_warehouse(spark, sf_dir))


def full_load(spark, sf_dir):
    """CSV files -> 17 tables -> gate (raises on failure) -> stored row counts."""
    root = scratch_path(spark, "full-load")
    prefixes = _landed(spark, sf_dir, root)
    db, location = _database(spark, "warehouse")
    quality.enforce(load.run_load(spark, prefixes, db, location))
    return ops.row_counts(sink.read_all(spark, db))


def incremental_ingest(spark, sf_dir):
    """Ratings landing in two drops; one checkpoint; whole fact table back."""
    root = scratch_path(spark, "ingest")
    ratings = catalog.ratings_frame(catalog.load_tables(spark, sf_dir, ["lineitem"]))
    first_drop = F.col("timestamp") < F.unix_date(F.lit("1998-01-01").cast("date")) * 86400
    db, location = _database(spark, "ingest-db")
    sink.create_all(spark, db, location, ["fact_rating"])
    landing = f"{root}/landing"
    write_csv(ratings.filter(first_drop), f"{landing}/drop1", quoted=False)
    run_ingest(spark, "ratings", f"{landing}/*", db, f"{root}/checkpoint")
    write_csv(ratings.filter(~first_drop), f"{landing}/drop2", quoted=False)
    run_ingest(spark, "ratings", f"{landing}/*", db, f"{root}/checkpoint")
    return _no_audit(spark.table(f"{db}.fact_rating"))


def incremental_dims(spark, sf_dir):
    """Keywords landing in two drops (orders before 1998, then the rest):
    dimension keys are appended once."""
    root = scratch_path(spark, "ingest-kw")
    t = catalog.load_tables(spark, sf_dir, ["lineitem", "part", "orders"])
    early = t["orders"].filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).select("o_orderkey")
    drops = [
        ops.semi_join(t["lineitem"], early, ["l_orderkey"], ["o_orderkey"]),
        ops.anti_join(t["lineitem"], early, ["l_orderkey"], ["o_orderkey"]),
    ]
    db, location = _database(spark, "ingest-kw-db")
    sink.create_all(spark, db, location, ["dim_keywords", "movie_keywords"])
    landing = f"{root}/landing"
    for i, lines in enumerate(drops, start=1):
        write_csv(catalog.keywords_frame({**t, "lineitem": lines}), f"{landing}/drop{i}", quoted=True)
        run_ingest(spark, "keywords", f"{landing}/*", db, f"{root}/checkpoint")
    return spark.table(f"{db}.dim_keywords").select("id", "name")


# --- one check per table builder (values, not just counts) -----------------
def _family_tables(spark: SparkSession, sf_dir: str, family: str, name: str) -> dict[str, DataFrame]:
    """The table ``name`` and what is built with it; no other list is parsed."""
    t = catalog.load_tables(spark, sf_dir)
    if family == "credits":
        return tables.people_tables(tables.credit_people(catalog.credits_frame(t), roles=[name.rpartition("_")[2]]))
    frames = {"movies_metadata": catalog.movies_frame, "keywords": catalog.keywords_frame, "ratings": catalog.ratings_frame}
    lists = [c for c, of in tables.LIST_TABLES.items() if name in of]
    return tables.build_warehouse({family: frames[family](t)}, lists=lists)


_TABLE_FAMILY = {
    "dim_movies": "movies_metadata",
    "dim_genres": "movies_metadata",
    "movie_genres": "movies_metadata",
    "dim_companies": "movies_metadata",
    "movie_production_companies": "movies_metadata",
    "dim_countries": "movies_metadata",
    "movie_countries": "movies_metadata",
    "movie_languages": "movies_metadata",
    "movie_cast": "credits",
    "dim_crew": "credits",
    "movie_crew": "credits",
    "dim_keywords": "keywords",
    "fact_rating": "ratings",
}


def _table_query(name: str) -> Query:
    def query(spark, sf_dir):
        return _no_audit(_family_tables(spark, sf_dir, _TABLE_FAMILY[name], name)[name])

    query.__name__ = f"table_{name}"
    query.__doc__ = f"``{name}`` as built from the derived catalog (audit column dropped)."
    return query


def conform_lengths(spark, sf_dir):
    """Rows that break a declared length (K4): document texts as cast names."""
    docs = _t(spark, sf_dir, "documents")
    as_cast = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.col("text").alias("name"),
        F.col("lang").alias("character"), F.lit(None).cast("string").alias("gender"),
    )
    return sink.conform_report({"dim_cast": as_cast})


def parse_losses(spark, sf_dir):
    """What strict parsing drops, per kind of defect (Q6 parse-loss counts)."""
    c = _t(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    item = F.concat(F.lit("{'id': "), F.col("c_custkey").cast("string"), F.lit(", 'name': '"), F.col("c_name"), F.lit("'"))
    text = (
        F.when(seg == "HOUSEHOLD", F.concat(F.lit("["), item, F.lit(", 'x': None}]")))
        .when(seg == "MACHINERY", F.concat(F.lit("["), item))
        .when(seg == "FURNITURE", F.lit("[]"))
        .when(seg == "BUILDING", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("["), item, F.lit("}, "), item, F.lit("}]")))
    )
    nested = c.select(seg.alias("segment"), text.alias("people"))
    return fn.nested_parse_report(nested, "people", by=["segment"])


# --- loads: published whole, rejects and losses told, batches merged ---------
def _text_of(name: str) -> F.Column:
    """A stored row as one text: declared columns by name, without the audit
    column and surrogate ids; doubles with four decimals."""
    t = TABLES[name]
    kept = sorted((c for c in t.columns if c.name not in ("last_updated", t.identity)), key=lambda c: c.name)
    texts = [(F.col(c.name).cast("decimal(18,4)") if c.type.simpleString() == "double" else F.col(c.name)).cast("string") for c in kept]
    return F.concat_ws("|", *[F.coalesce(x, F.lit("~")) for x in texts])


def table_digests(w: dict[str, DataFrame], step: str) -> DataFrame:
    """``(step, table, rows, digest)``: the digest adds up a hash of every row."""
    out = None
    for name, df in w.items():
        part = F.conv(F.substring(F.md5(_text_of(name).cast("binary")), 1, 8), 16, 10).cast("long")
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(part), F.lit(0)).alias("digest"))
        one = one.select(F.lit(step).alias("step"), F.lit(name).alias("table"), "rows", "digest")
        out = one if out is None else out.unionByName(one)
    return out


def load_retry(spark, sf_dir):
    """A load that fails after its ninth table shows nothing; run again under
    its id it shows all 17 tables; run a third time it changes nothing."""
    root = scratch_path(spark, "load-retry")
    prefixes = _landed(spark, sf_dir, root)
    db, location = _database(spark, "load-retry-db")
    written: list[str] = []

    def fail(name: str) -> None:
        written.append(name)
        if len(written) == 9:
            raise ConnectionError("lost after the ninth table")

    try:
        load.run_load(spark, prefixes, db, location, load_id="retried", parallelism=1, on_table=fail)
    except ConnectionError:
        failed = table_digests(sink.read_all(spark, db), "failed")
    quality.enforce(load.run_load(spark, prefixes, db, load_id="retried"))
    rerun = table_digests(sink.read_all(spark, db), "rerun")
    load.run_load(spark, prefixes, db, load_id="retried")
    return failed.unionByName(rerun).unionByName(table_digests(sink.read_all(spark, db), "again"))


def rating_batches(spark, sf_dir):
    """Ratings by batch load, stream, batch load and stream into one ``fact_rating``."""
    root = scratch_path(spark, "rating-batches")
    db, location = _database(spark, "rating-batches-db")
    ratings = catalog.ratings_frame(catalog.load_tables(spark, sf_dir, ["lineitem"]))
    day = F.floor(F.col("timestamp") / 86400) % 4
    for i in range(4):
        drop = ratings.filter(day == i)
        if i % 2 == 0:
            prefixes = load.write_sources({"ratings": drop}, f"{root}/batch{i}")
            load.run_load(spark, prefixes, db, location)
        else:
            write_csv(drop, f"{root}/landing/drop{i}", quoted=False)
            run_ingest(spark, "ratings", f"{root}/landing/*", db, f"{root}/checkpoint")
    return _no_audit(sink.read_all(spark, db, ["fact_rating"])["fact_rating"])


def _in_drops(spark: SparkSession, tag: str, family: str, first: DataFrame, second: DataFrame) -> dict[str, str]:
    """Three warehouses with merged survivors: both drops in one load, one after the
    other, and the other way round; their databases by step.  The drops' files are
    written once, for all three to load."""
    out = {}
    root = scratch_path(spark, tag)
    for name, drop in (("drop-1", first), ("drop-2", second)):
        load.write_sources({family: drop}, f"{root}/{name}")
    for step, drops in {"one": ["drop-"], "two": ["drop-1", "drop-2"], "reversed": ["drop-2", "drop-1"]}.items():
        db, location = _database(spark, f"{tag}-{step}-db")
        for drop in drops:
            load.run_load(spark, {family: f"{root}/{drop}"}, db, location, merge_parts=8)
        out[step] = db
    remove_scratch(spark, root)
    return out


def merged_survivors(spark, sf_dir):
    """Keywords whose names differ between two drops (D2): one load, both
    drops in turn and in reverse give the same dimension."""
    t = catalog.load_tables(spark, sf_dir, ["lineitem", "part"])
    odd = F.col("l_linenumber") % 2 == 1
    other = F.concat(F.when(F.col("p_partkey") % 2 == 0, F.lit("A ")).otherwise(F.lit("zz ")), F.col("p_name"))
    first = catalog.keywords_frame({**t, "lineitem": t["lineitem"].where(odd)})
    second = catalog.keywords_frame({"lineitem": t["lineitem"].where(~odd), "part": t["part"].withColumn("p_name", other)})
    out = None
    for step, db in _in_drops(spark, "merged-keywords", "keywords", first, second).items():
        part = sink.read_all(spark, db, ["dim_keywords"])["dim_keywords"].select(F.lit(step).alias("step"), "id", "name")
        out = part if out is None else out.unionByName(part)
    return out


def merged_movies(spark, sf_dir):
    """Movies in two drops, half of them in both with another title and revenue (D1, D2): per
    order of the drops the movies, those unlike the single load, those whose
    dimension and sales come from different rows, and the genre rows."""
    paths: list[str] = []
    movies = _staged(spark, catalog.movies_frame(catalog.load_tables(spark, sf_dir)), "merged-source", paths)
    quarter = F.col("id") % 4
    first = movies.where(quarter != 1)
    second = movies.where(quarter != 3).withColumns({"title": F.lit("Again"), "revenue": F.lit(-1.0).cast(movies.schema["revenue"].dataType)})
    read = {step: sink.read_all(spark, db) for step, db in _in_drops(spark, "merged-movies", "movies_metadata", first, second).items()}
    remove_scratch(spark, *paths)
    single = read["one"]["dim_movies"].select(F.col("id").alias("one_id"), F.col("title").alias("one_title"))
    out = None
    for step, w in read.items():
        rows = w["dim_movies"].join(w["fact_movie_sales"], F.col("id") == F.col("movie_id"), "full").join(single, F.col("id") == F.col("one_id"), "full")
        part = rows.agg(
            F.count("id").alias("movies"),
            F.count_if(~F.col("title").eqNullSafe(F.col("one_title"))).alias("unlike_one"),
            F.count_if(~(F.col("title") == "Again").eqNullSafe(F.col("revenue") == -1)).alias("mixed"),
        )
        part = part.crossJoin(w["movie_genres"].agg(F.count(F.lit(1)).alias("genre_rows"))).select(F.lit(step).alias("step"), "*")  # one row beside one row
        out = part if out is None else out.unionByName(part)
    return out


def replayed_batch(spark, sf_dir):
    """The same micro-batch applied three times (a stream's replays): once in the tables."""
    root = scratch_path(spark, "replayed")
    db, location = _database(spark, "replayed-db")
    sink.create_all(spark, db, location, ["dim_keywords", "movie_keywords"])
    batch = catalog.keywords_frame(catalog.load_tables(spark, sf_dir, ["lineitem", "part"]))
    for _ in range(3):
        process_batch(batch, 0, "keywords", db, f"{root}/state")
    return sink.read_all(spark, db, ["movie_keywords"])["movie_keywords"].select("movie_id", "keyword_id")


def _customer_keywords(spark, sf_dir, item, text) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("long").alias("id"), text(F.col("c_mktsegment"), item).alias("keywords"))


def reject_sink(spark, sf_dir):
    """Planted defects (K4): ids that are no numbers, names over the declared
    length; what is stored, what is rejected and what the load's report says."""
    seg = F.col("c_mktsegment")
    ident = F.concat(F.col("c_custkey").cast("string"), F.when(seg == "HOUSEHOLD", F.lit("a")).otherwise(F.lit("")))
    name = F.when(seg == "MACHINERY", F.repeat("c_name", 40)).otherwise(F.col("c_name"))
    item = F.concat(F.lit("[{'id': '"), ident, F.lit("', 'name': '"), name, F.lit("'}]"))
    root = scratch_path(spark, "reject-sink")
    db, location = _database(spark, "reject-sink-db")
    prefixes = load.write_sources({"keywords": _customer_keywords(spark, sf_dir, item, lambda _, i: i)}, root)
    report = load.run_load(spark, prefixes, db, location)
    told = report.filter((F.col("rule") == "rejected_rows")).select(F.lit("report").alias("kind"), "table", F.lit("").alias("reason"), F.col("violations").alias("n"))
    why = F.substring_index("reason", ":", 2)
    rejects = ledger.read_rejects(spark, db).groupBy(F.col("table_name").alias("table"), why.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    stored = ops.row_counts(sink.read_all(spark, db, ["dim_keywords", "movie_keywords"]))
    return (
        told.unionByName(rejects.select(F.lit("reject").alias("kind"), "table", "reason", "n"))
        .unionByName(stored.select(F.lit("stored").alias("kind"), "table", F.lit("").alias("reason"), F.col("rows").alias("n")))
    )


def load_parse_losses(spark, sf_dir):
    """Planted ``None``, truncated, blank, missing and empty lists (Q6): losses
    counted while staging, as told by the load's report, beside what is stored."""
    item = F.concat(F.lit("{'id': "), F.col("c_custkey").cast("string"), F.lit(", 'name': '"), F.col("c_name"), F.lit("'"))

    def text(seg, item):
        return (
            F.when(seg == "HOUSEHOLD", F.concat(F.lit("["), item, F.lit(", 'x': None}]")))
            .when(seg == "MACHINERY", F.concat(F.lit("["), item))
            .when(seg == "FURNITURE", F.when(F.col("c_acctbal") > 0, F.lit("[]")).otherwise(F.lit("  ")))
            .when(seg == "BUILDING", F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("["), item, F.lit("}]")))
        )

    root = scratch_path(spark, "parse-losses")
    db, location = _database(spark, "parse-losses-db")
    prefixes = load.write_sources({"keywords": _customer_keywords(spark, sf_dir, item, text)}, root)
    report = load.run_load(spark, prefixes, db, location)
    told = report.filter(F.col("rule") == "parse_loss").select("rule", "table", "column", F.col("violations").alias("n"))
    stored = ops.row_counts(sink.read_all(spark, db, ["movie_keywords"]))
    return told.unionByName(stored.select(F.lit("stored").alias("rule"), "table", F.lit("*").alias("column"), F.col("rows").alias("n")))


# --- one hot key holding about a third of the rows ----------------------------
def _hot_movie(col: str = "l_orderkey") -> F.Column:
    """Lineitems 1 and 2 of every order (about 29% of all rows) re-keyed to
    movie 0, the rest keep their order: one key with a third of the data."""
    return F.when(F.col("l_linenumber") <= 2, F.lit(0)).otherwise(F.col(col)).cast("long")


def hot_key_bridge(spark, sf_dir):
    """Keywords of a hot movie: nested in bounded chunks, exploded back."""
    t = catalog.load_tables(spark, sf_dir, ["lineitem", "part"])
    li = fn.scan_chunks(t["lineitem"], catalog.CHUNK).select(_hot_movie().alias("movie"), "l_partkey", "__nm_chunk")
    li = fn.split_large(li, "movie", catalog.CHUNK)
    li = li.join(t["part"].select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    nested = fn.nest_json(li, ["movie"], {"id": F.col("p_partkey"), "name": F.col("p_name")}, "keywords", catalog.CHUNK, chunk="__nm_chunk")
    _, bridge = tables.keywords(nested.withColumnRenamed("movie", "id"))
    return bridge


def list_lengths(spark, sf_dir):
    """Keyword and credit rows per movie and the elements they carry: one whole list for a
    movie, several of at most ``CHUNK`` elements for the hot one."""
    t = catalog.load_tables(spark, sf_dir)
    hot = {**t, "lineitem": t["lineitem"].withColumn("l_orderkey", _hot_movie())}
    out = None
    for kind, frame, column in (
        ("keywords", catalog.keywords_frame(t), "keywords"), ("credits", catalog.credits_frame(t), "cast"), ("hot", catalog.keywords_frame(hot), "keywords"),
    ):
        n = F.size(fn.parse_list(F.col(column)))
        per = frame.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.sum(n).alias("elements"), F.max(n).alias("longest"))
        whole = per.agg(
            F.count_if(F.col("rows") == 1).alias("whole"), F.count_if(F.col("rows") > 1).alias("cut"),
            F.sum("elements").alias("elements"), F.count_if(F.col("longest") > catalog.CHUNK).alias("too_long"),
        )
        one = whole.select(F.lit(kind).alias("kind"), "whole", "cut", "elements", "too_long")
        out = one if out is None else out.unionByName(one)
    return out


def hot_key_ratings(spark, sf_dir):
    """``fact_rating`` when one movie holds about a third of all ratings."""
    li = _t(spark, sf_dir, "lineitem").select(_hot_movie().alias("movieId"), "l_suppkey", "l_quantity")
    ratings = li.select(
        F.col("l_suppkey").cast("long").alias("userId"), "movieId",
        F.ceil(F.col("l_quantity") / 10).cast("float").alias("rating"),
    )
    return _no_audit(tables.fact_rating(ratings))


def hot_key_semi(spark, sf_dir):
    """Movies with a PROMO part, when one movie holds a third of the bridge rows."""
    li = _t(spark, sf_dir, "lineitem").select(_hot_movie().alias("movie_id"), "l_partkey")
    promo = _t(spark, sf_dir, "part").filter(F.col("p_type") == "PROMO").select("p_partkey")
    hits = ops.semi_join(li, promo, ["l_partkey"], ["p_partkey"])
    movies = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long").alias("id"))
    return ops.semi_join(movies, hits, ["id"], ["movie_id"])



QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in [
        csv_scan,
        csv_prefix_union,
        csv_quoted_text,
        sql_view,
        project_rename_audit,
        filter_not_null_fill,
        filter_null_safe_neq,
        date_range,
        year_filter,
        json_key_lookup,
        json_bridge,
        json_dim,
        json_pyliteral,
        json_python_literal,
        movies_staged,
        fact_sales,
        language_dim,
        dedup_ordered,
        dedup_latest,
        code_label,
        lookup_name,
        group_stats,
        row_counts,
        profile,
        sorted_orders,
        top_revenue,
        surrogate_key,
        surrogate_key_payload,
        shifted_keys,
        distinct_count,
        append_read_back,
        surrogate_ids_unique,
        target_reset,
        pk_violations,
        fk_orphans,
        orphan_count,
        null_check,
        positive_check,
        quality_gate,
        quality_gate_defects,
        question_b1,
        question_b1_original,
        question_b2,
        question_b3,
        question_b4,
        question_b5,
        star_load,
        full_load,
        incremental_ingest,
        incremental_dims,
        conform_lengths,
        parse_losses,
        load_retry,
        rating_batches,
        merged_survivors,
        merged_movies,
        replayed_batch,
        reject_sink,
        load_parse_losses,
        hot_key_bridge,
        list_lengths,
        hot_key_ratings,
        hot_key_semi,
        *[_table_query(name) for name in _TABLE_FAMILY],
    ]
}
