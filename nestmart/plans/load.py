"""Full load in dependency order.

movies first; then keywords, credits and ratings; then the quality gate.

Each source family is one prefix scan.  The deduplicated movies feed ten
outputs, so they are written once to a staging table in the shared folder
and every movie output reads that (one CSV scan instead of ten, and a stable
survivor for ``dim_movies`` and ``fact_movie_sales`` alike, even when a task
is retried).  Likewise the cast and crew lists, the bulk of the credits
files, are parsed once into a staged table that feeds the four cast/crew
outputs (one scan and one parse instead of four).

A load has an id.  All of its tables are written under it and published
together by one ledger entry, so readers never see half a load; a load
that failed is run again under the same id, and one that is published is not run
twice.  While the lists are staged, named observations count the texts that
do not parse and the elements that cannot be stored; both come with the gate's
report, without another pass over the data.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.values import values_frame
from ..operators.joins import anti_join
from ..schemas import CREATE_ORDER, QUOTED_SOURCES, SOURCE_SCHEMAS
from ..session import remove_scratch, scratch_path, shuffles_removed
from ..sinks import ledger
from ..sinks.ledger import Entry
from ..sinks.warehouse import create_all, last_seq, merges, read_all, stage_table, write_rejects
from ..sources.csv import read_prefix, write_csv
from . import quality, tables

log = logging.getLogger(__name__)

FAMILIES = ("movies_metadata", "keywords", "credits", "ratings")


def write_sources(frames: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """Write raw source frames as gzipped CSV, one file per task, under ``root/<family>/``."""
    out = {}
    for family, df in frames.items():
        path = f"{root}/{family}"
        with shuffles_removed(df.sparkSession):
            write_csv(df, path, quoted=family in QUOTED_SOURCES, compression="gzip")
        out[family] = path
    return out


def read_sources(spark: SparkSession, prefixes: Mapping[str, str], multi_line: bool = False) -> dict[str, DataFrame]:
    """One prefix scan per family with its declared schema and dialect.

    ``multi_line`` keeps newlines inside quoted fields (files are then read
    whole, one task per file); the default splits records at every newline,
    as the original did.
    """
    return {
        family: read_prefix(spark, prefix, SOURCE_SCHEMAS[family], quoted=family in QUOTED_SOURCES, multi_line=multi_line and family in QUOTED_SOURCES)
        for family, prefix in prefixes.items()
    }


@dataclass
class Staged:
    """What a load writes, read back from its staging folders."""

    frames: dict[str, DataFrame] = field(default_factory=dict)
    #: (source, column, texts that do not parse)
    losses: list[tuple[str, str, int]] = field(default_factory=list)
    #: (table, elements that cannot be stored, their number)
    refused: list[tuple[str, DataFrame, int]] = field(default_factory=list)
    paths: list[str] = field(default_factory=list)

    def add(self, other: Staged) -> None:
        self.frames.update(other.frames)
        self.losses += other.losses
        self.refused += other.refused
        self.paths += other.paths


def _store(df: DataFrame, tag: str, out: Staged) -> DataFrame:
    path = scratch_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    out.paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _store_elements(source: str, columns: list[str], elements, kinds: dict[str, tuple[str, F.Column]], out: Staged) -> DataFrame:
    """Write the elements of a source's lists once, counting what is lost and what
    is refused as the rows pass (a narrow job, so no row is counted twice)."""
    losses, bad = Observation(f"losses_{source}"), Observation(f"refused_{source}")
    rows = elements(losses)
    counts = [F.count_if(F.col("bad").isNotNull() & which).alias(kind) for kind, (_, which) in kinds.items()]
    stored = _store(rows.observe(bad, *counts), f"staged-{source}", out)
    told, refused = losses.get, bad.get
    out.losses += [(source, c, int(told.get(c, 0))) for c in columns]
    for kind, (table, which) in kinds.items():
        if refused.get(kind, 0):
            out.refused.append((table, stored.where(F.col("bad").isNotNull() & which), int(refused[kind])))
    return stored


_KIND_TABLE = {"genre": "movie_genres", "company": "movie_production_companies"}


def stage_movies(raw: DataFrame, reproducible: bool | str = False, nested_mode: str = "strict", narrow: Callable[[DataFrame], DataFrame] | None = None) -> Staged:
    """Deduplicated movies and their lists' elements; ``narrow`` keeps some of the movies."""
    out = Staged()
    movies = tables.staged_movies(raw, reproducible)
    columns = ["id", *tables.DIM_MOVIES_COLUMNS[1:], *tables.SALES_COLUMNS[1:], *tables.MOVIE_LISTS]
    columns += ["order_key"] if reproducible == tables.MERGED else []
    movies = _store((narrow(movies) if narrow else movies).select(*columns), "staged-movies", out)
    kinds = {k: (t, F.col("kind") == k) for k, t in _KIND_TABLE.items()}
    elements = _store_elements("movies_metadata", list(tables.MOVIE_LISTS), lambda o: tables.movie_elements(movies, nested_mode, o), kinds, out)
    out.frames = tables.build_warehouse({}, reproducible, nested_mode, staged=movies, elements=elements)
    return out


def stage_credits(raw: DataFrame, reproducible: bool | str = False, nested_mode: str = "strict") -> Staged:
    """Cast and crew elements, parsed once."""
    out = Staged()
    kinds = {role: (f"movie_{role}", F.col("role") == role) for role in ("cast", "crew")}
    people = _store_elements("credits", ["cast", "crew"], lambda o: tables.credit_people(raw, nested_mode, o), kinds, out)
    out.frames = tables.build_warehouse({}, reproducible, nested_mode, people=people)
    return out


def stage_keywords(raw: DataFrame, reproducible: bool | str = False, nested_mode: str = "strict") -> Staged:
    """Keyword elements, parsed once."""
    out = Staged()
    kinds = {"keyword": ("movie_keywords", F.lit(True))}
    rows = _store_elements("keywords", ["keywords"], lambda o: tables.keyword_elements(raw, nested_mode, o), kinds, out)
    out.frames = tables.build_warehouse({}, reproducible, nested_mode, keyword_rows=rows)
    return out


def stage_ratings(raw: DataFrame, reproducible: bool | str = False, nested_mode: str = "strict") -> Staged:
    return Staged({"fact_rating": tables.rating_stats(raw)})


STAGE = {"movies_metadata": stage_movies, "credits": stage_credits, "keywords": stage_keywords, "ratings": stage_ratings}


def new_lists(spark: SparkSession, staged: Staged, database: str) -> None:
    """Where survivors are merged, a movie that an earlier load has brought may come again:
    its list rows are in the bridges already and are not appended twice."""
    bridges = [n for n in ("movie_genres", "movie_production_companies", "movie_countries", "movie_languages") if n in staged.frames]
    if bridges:
        known = read_all(spark, database, ["dim_movies"])["dim_movies"].select("id")
        staged.frames.update({n: anti_join(staged.frames[n], known, ["movie_id"], ["id"]) for n in bridges})


def write_load(spark: SparkSession, staged: Staged, database: str, load_id: str, mode: str = "append", parallelism: int = 4, on_table: Callable[[str], None] | None = None) -> list[Entry]:
    """Write all tables of a load, then publish them together.

    Each table is its own job; small dimensions leave most of a cluster idle,
    so several run side by side (as the original ran its families in
    parallel).  ``on_table`` is called after each table.  If anything fails,
    nothing is published.
    """
    until = last_seq(spark, database)
    ledger.drop_load(spark, f"{database}.{ledger.REJECTS}", load_id)  # of a failed try

    def one(name: str) -> list[Entry]:
        new = stage_table(staged.frames[name], database, name, load_id, mode)
        if on_table:
            on_table(name)
        return new

    # the table that is aggregated on the way takes longest: it starts first
    names = sorted((n for n in CREATE_ORDER if n in staged.frames), key=lambda n: n not in ledger.EXTRA)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        new = [e for of in pool.map(one, names) for e in of]
    refused: dict[str, int] = {}
    for table, rows, n in staged.refused:
        write_rejects(rows.select(F.col("bad").alias("reason"), F.to_json(F.struct(*[c for c in rows.columns if c != "bad"])).alias("row")), database, table, load_id)
        refused[table] = n
    new = [e if e.table not in refused else Entry(e.table, e.load_id, e.part, e.replaces, e.rows, e.rejected + refused[e.table]) for e in new]
    ledger.publish(spark, database, new, until if mode == "append" else None)
    return new


def run_load(
    spark: SparkSession,
    prefixes: Mapping[str, str],
    database: str,
    location: str | None = None,
    mode: str = "append",
    reproducible: bool | str = False,
    nested_mode: str = "strict",
    parallelism: int = 4,
    multi_line: bool = False,
    buckets: int | None = None,
    load_id: str | None = None,
    on_table: Callable[[str], None] | None = None,
    merge_parts: int | None = None,
) -> DataFrame:
    """Load every family into ``database`` and return the gate report.

    The report is a frame ``(rule, table, column, violations)``; pass it to
    ``quality.enforce`` to stop on failures.  Besides the gate's rules it has
    ``parse_loss`` (texts of a list column that do not parse) and
    ``rejected_rows`` (rows and list elements kept in the reject table), which do
    not count as failures.  ``buckets`` creates new tables bucketed by movie id (see
    ``sinks.warehouse.create_all``).  ``load_id`` names the load: run again
    after a failure it starts anew, run again after success it only reports.
    ``merge_parts`` creates new tables with survivors merged across loads (see
    ``create_all``); later loads and streams of such a warehouse merge without it.
    """
    create_all(spark, database, location, buckets=buckets, merge_parts=merge_parts)
    load_id = load_id or ledger.new_load_id()
    if not re.fullmatch(r"[A-Za-z0-9_-]+", load_id):
        raise ValueError("a load id has letters, digits, _ and - only")
    if ledger.published(ledger.entries(spark, database), load_id):
        log.info("load %s is published already", load_id)
        return quality.gate(read_all(spark, database))
    raw = read_sources(spark, prefixes, multi_line)
    merged = merges(spark, database)
    if merged:
        reproducible = tables.MERGED
    staged = Staged()
    # independent staging jobs run side by side; shuffle files go with the write that made them
    with shuffles_removed(spark):
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, 3))) as pool:
            parts = [pool.submit(STAGE[f], raw[f], reproducible, nested_mode) for f in FAMILIES if f in raw]
            for part in parts:
                staged.add(part.result())
        if merged and mode == "append":
            new_lists(spark, staged, database)
        new = write_load(spark, staged, database, load_id, mode, parallelism, on_table)
    remove_scratch(spark, *staged.paths)
    rejected = {}
    for e in new:
        log.info("wrote %s rows to %s.%s", e.rows, database, e.table)
        rejected[e.table] = rejected.get(e.table, 0) + e.rejected
    rows = [("parse_loss", t, c, n) for t, c, n in staged.losses] + [("rejected_rows", t, "*", n) for t, n in rejected.items()]
    report = quality.gate(read_all(spark, database))
    if not rows:
        return report
    return report.unionByName(values_frame(spark, rows, report.columns).withColumn("violations", F.col("violations").cast("long")))
