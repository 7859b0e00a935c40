"""Load ledger: what each load wrote, and which of it readers see.

Every target is stored as ``<table>__loads``, partitioned by ``load_id`` and ``part``.
A load writes its own partitions only; nothing of it is seen until ``publish`` appends
its rows to ``load_ledger``, one small file for all tables together, so a load
appears whole or not at all.  A failed load leaves partitions nobody reads; the
same load id written again replaces them.

Ledger rows ``(seq, load_id, table_name, part, replaces, row_count, rejected,
published_at)``: ``part`` null stands for all parts, ``replaces`` retires what
earlier loads put there, a null ``load_id`` puts nothing in its place (a reset).

Readers take one look at the ledger and read the live partitions of all
tables by literal partition filters, so pruning and bucketed joins work as on a plain
table, and 17 tables read together belong to the same loads.  ``<table>`` itself is a view with
these filters, renewed at each publish, for SQL.

The ledger is collected: one row for each table (or touched part) of each load.
``compact`` folds a table's loads into one; ``drop_unpublished`` removes what is
not live.  Two loads that replace the same part at once are told apart: the
later publish fails (``LedgerConflict``) and its load can be run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import values_frame
from ..schemas import TABLES

LEDGER, REJECTS = "load_ledger", "load_rejects"
_COLUMNS = "seq BIGINT, load_id STRING, table_name STRING, part INT, replaces BOOLEAN, row_count BIGINT, rejected BIGINT, published_at TIMESTAMP"

#: Columns kept beside the declared ones, so that averages can be merged.
EXTRA = {"fact_rating": {"rating_total": "double", "rating_values": "bigint"}}

#: Tables of one row per key whose survivors can be merged across loads, and their keys.
MERGEABLE = {
    "dim_movies": "id",
    "fact_movie_sales": "movie_id",
    "dim_genres": "id",
    "dim_companies": "id",
    "dim_countries": "iso_code",
    "dim_languages": "iso_code",
    "dim_cast": "id",
    "dim_crew": "id",
    "dim_keywords": "id",
}

#: Of these, the ones kept with an order key of the source row, so that both choose the same row.
ORDER_KEY = {"dim_movies": "order_key", "fact_movie_sales": "order_key"}

#: table -> load_id -> parts (None: all)
Live = Mapping[str, Mapping[str, frozenset[int] | None]]


class LedgerConflict(RuntimeError):
    pass


@dataclass(frozen=True)
class Entry:
    table: str
    load_id: str | None
    part: int | None = None
    replaces: bool = False
    rows: int = 0
    rejected: int = 0


def new_load_id() -> str:
    return uuid.uuid4().hex


def physical(database: str, name: str) -> str:
    return f"{database}.{name}__loads"


def create(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{LEDGER} ({_COLUMNS}) USING parquet")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{REJECTS} (reason STRING, row STRING, load_id STRING, table_name STRING) USING parquet PARTITIONED BY (load_id, table_name)")


def entries(spark: SparkSession, database: str) -> list:
    """All ledger rows in publish order (one per table or touched part of each load)."""
    rows = spark.table(f"{database}.{LEDGER}").collect()
    return sorted(rows, key=lambda r: (r["seq"], r["published_at"], r["load_id"] or "", r["part"] is not None, r["part"] or 0))


def published(rows: Iterable, load_id: str) -> bool:
    return any(r["load_id"] == load_id for r in rows)


def live(rows: Iterable) -> dict[str, dict[str, frozenset[int] | None]]:
    """Which parts of which loads are seen, per table."""
    whole: dict[str, dict[str, None]] = {}
    parts: dict[str, dict[int, str]] = {}
    for r in rows:
        t, part, load_id = r["table_name"], r["part"], r["load_id"]
        if part is None:
            if r["replaces"]:
                whole[t], parts[t] = {}, {}
            if load_id is not None:
                whole.setdefault(t, {})[load_id] = None
        else:
            parts.setdefault(t, {})[part] = load_id
    out: dict[str, dict[str, frozenset[int] | None]] = {t: dict(loads) for t, loads in whole.items()}
    for t, of in parts.items():
        for part, load_id in of.items():
            have = out.setdefault(t, {}).get(load_id, frozenset())
            out[t][load_id] = None if have is None else have | {part}
    return out


def predicate(loads: Mapping[str, frozenset[int] | None] | None) -> str:
    """Partition filter of a table's live loads."""
    if not loads:
        return "false"
    quoted = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    whole = ", ".join(sorted(quoted(i) for i, parts in loads.items() if parts is None))
    terms = [f"load_id IN ({whole})"] if whole else []
    terms += [f"(load_id = {quoted(i)} AND part IN ({', '.join(map(str, sorted(parts)))}))" for i, parts in sorted(loads.items()) if parts is not None]
    return "(" + " OR ".join(terms) + ")"


def read(spark: SparkSession, database: str, name: str, seen: Live, with_extra: bool = False) -> DataFrame:
    """The published rows of a table; its declared columns."""
    columns = TABLES[name].column_names + (list(EXTRA.get(name, {})) if with_extra else [])
    return spark.table(physical(database, name)).where(predicate(seen.get(name))).select(*columns)


def refresh_views(spark: SparkSession, database: str, names: Iterable[str], seen: Live) -> None:
    for name in names:
        columns = ", ".join(f"`{c}`" for c in TABLES[name].column_names)
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {columns} FROM {physical(database, name)} WHERE {predicate(seen.get(name))}")


def publish(spark: SparkSession, database: str, new: Iterable[Entry], seen_until: int | None = None) -> None:
    """Make a load's partitions visible, all tables at once.

    ``seen_until`` is the last ``seq`` the load built on; what it replaces must not
    have been written to since.
    """
    new = list(new)
    if not new:
        return
    spark.catalog.refreshTable(f"{database}.{LEDGER}")
    rows = entries(spark, database)
    if seen_until is not None:
        since = [(r["table_name"], r["part"]) for r in rows if r["seq"] > seen_until]
        mine = {(e.table, e.part) for e in new if e.replaces}
        if any((t, p) in mine or (t, None) in mine or (p is None and any(t == m for m, _ in mine)) for t, p in since):
            raise LedgerConflict(f"{database}: another load wrote to the same parts; run this load again")
    seq = max((r["seq"] for r in rows), default=0) + 1
    frame = values_frame(spark, [(seq, e.load_id, e.table, e.part, e.replaces, e.rows, e.rejected) for e in new], ["seq", "load_id", "table_name", "part", "replaces", "row_count", "rejected"])
    types = dict(c.strip().split() for c in _COLUMNS.split(","))
    frame = frame.withColumn("published_at", F.current_timestamp())
    frame.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()]).coalesce(1).write.insertInto(f"{database}.{LEDGER}")
    spark.catalog.refreshTable(f"{database}.{LEDGER}")
    names = dict.fromkeys(e.table for e in new if e.table in TABLES)
    known = [n for n in names if spark.catalog.tableExists(physical(database, n))]
    for name in known:
        spark.catalog.refreshTable(physical(database, name))
    refresh_views(spark, database, known, live(entries(spark, database)))


def read_rejects(spark: SparkSession, database: str) -> DataFrame:
    """``(load_id, table_name, reason, row)`` of the published loads' rejected rows."""
    ids = sorted({r["load_id"] for r in entries(spark, database) if r["load_id"]})
    seen = predicate(dict.fromkeys(ids))
    return spark.table(f"{database}.{REJECTS}").where(seen).select("load_id", "table_name", "reason", "row")


def drop_load(spark: SparkSession, table: str, load_id: str) -> None:
    """Drop a load's partitions of a stored table (each by its full name: not every
    catalog takes a part of one)."""
    for row in spark.sql(f"SHOW PARTITIONS {table} PARTITION (load_id = '{load_id}')").collect():
        spec = ", ".join("{} = '{}'".format(*p.split("=", 1)) for p in row[0].split("/"))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def drop_unpublished(spark: SparkSession, database: str, keep: Iterable[str] = ()) -> int:
    """Drop stored partitions that no reader sees (failed or retired loads), but
    for the loads in ``keep`` (those still being written); returns their number."""
    kept, dropped = set(keep), 0
    seen = live(entries(spark, database))
    for name in TABLES:
        if not spark.catalog.tableExists(physical(database, name)):
            continue
        loads = seen.get(name, {})
        for row in spark.sql(f"SHOW PARTITIONS {physical(database, name)}").collect():
            load_id, part = (p.split("=", 1)[1] for p in row[0].split("/"))
            parts = loads.get(load_id, frozenset())
            if load_id not in kept and parts is not None and int(part) not in parts:
                spark.sql(f"ALTER TABLE {physical(database, name)} DROP IF EXISTS PARTITION (load_id = '{load_id}', part = {part})")
                dropped += 1
    return dropped


def compact(spark: SparkSession, database: str, name: str) -> str:
    """Write a table's live rows again as one load that replaces the others."""
    rows = entries(spark, database)
    loads = live(rows).get(name, {})
    columns = [c for c in spark.table(physical(database, name)).columns if c != "load_id"]
    frame = spark.table(physical(database, name)).where(predicate(loads)).select(*columns)
    load_id = new_load_id()
    insert(frame, database, name, load_id)
    until = max((r["seq"] for r in rows), default=0)
    parted = sorted({p for of in loads.values() if of is not None for p in of})
    new = [Entry(name, load_id, p, True) for p in parted] or [Entry(name, load_id, None, True)]
    publish(spark, database, new, until)
    return load_id


def insert(frame: DataFrame, database: str, name: str, load_id: str) -> None:
    """Write ``frame`` (declared and extra columns; with ``part`` last for tables kept in
    parts) as one load's partitions, in place of what the load had written."""
    spark = frame.sparkSession
    view = f"nm_write_{uuid.uuid4().hex}"
    frame.createOrReplaceTempView(view)
    parted = frame.columns[-1] == "part"
    part = "part" if parted else "part = 0"
    names = ", ".join(f"`{c}`" for c in frame.columns)
    try:
        # dropped, not overwritten: the frame may read other loads of this table
        drop_load(spark, physical(database, name), load_id)
        spark.sql(f"INSERT INTO {physical(database, name)} PARTITION (load_id = '{load_id}', {part}) SELECT {names} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
    spark.catalog.refreshTable(physical(database, name))
