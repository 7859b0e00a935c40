"""Warehouse sinks (K1-K5).

Targets are Parquet tables registered in the session catalog under one
database whose files live in a caller-chosen (shared) location.  Writes are
``append`` (what the original did) or ``overwrite`` (idempotent reruns), and
are seen once their load is published (see ``ledger``).

``conform`` casts each frame to its registered schema with lenient casts and
adds the bridge surrogate id.  Rows that fail a cast or break a declared length
(K4) would be refused by the warehouse: they go to ``load_rejects``, counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import safe_cast, with_audit
from ..operators.aggregate import observed
from ..operators.keys import with_row_id
from ..schemas import CREATE_ORDER, TABLES, Table, movie_key
from ..session import remove_scratch, scratch_path
from . import ledger
from .ledger import Entry


def _spark_type_ddl(t) -> str:
    return t.simpleString()


def create_all(
    spark: SparkSession,
    database: str,
    location: str | None = None,
    tables=None,
    buckets: int | None = None,
    rating_parts: int = 16,
    merge_parts: int | None = None,
) -> None:
    """Create every registered table if it is not there, and the load ledger (K2).

    ``buckets`` clusters every movie-keyed table (``dim_movies``, both facts
    and the seven bridges) by the movie id into that many buckets, so joins
    between them on the movie id read co-located buckets with no shuffle.
    ``rating_parts``: parts (by a hash of the movie id) that ``fact_rating`` is kept in.
    ``merge_parts`` keeps the dimensions and ``fact_movie_sales`` in that many parts by a
    hash of their key, with one survivor per key across loads: the least row, so
    that tables do not depend on how files are split into loads, or on their order (D2).
    """
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    ledger.create(spark, database)
    new = [n for n in tables or CREATE_ORDER if not spark.catalog.tableExists(ledger.physical(database, n))]
    for name in new:
        t = TABLES[name]
        cols = [f"`{c.name}` {_spark_type_ddl(c.type)}" for c in t.columns] + [f"`{c}` {k}" for c, k in ledger.EXTRA.get(name, {}).items()]
        key = movie_key(name)
        clustered = f" CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS" if buckets and key else ""
        parts = f" TBLPROPERTIES ('rating_parts' = '{rating_parts}')" if name in ledger.EXTRA else ""
        if merge_parts and name in ledger.MERGEABLE:
            parts = f" TBLPROPERTIES ('merge_parts' = '{merge_parts}')"
            cols += [f"`{ledger.ORDER_KEY[name]}` string"] if name in ledger.ORDER_KEY else []
        spark.sql(f"CREATE TABLE IF NOT EXISTS {ledger.physical(database, name)} ({', '.join(cols)}, load_id STRING, part INT) USING parquet PARTITIONED BY (load_id, part){clustered}{parts}")
    if new:
        ledger.refresh_views(spark, database, new, ledger.live(ledger.entries(spark, database)))


def bucket_count(spark: SparkSession, database: str, name: str) -> int | None:
    """Number of buckets declared for a stored table (catalog metadata only)."""
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {ledger.physical(database, name)}").collect():
        if row[0] == "Num Buckets":
            return int(row[1])
    return None


def _property(spark: SparkSession, database: str, name: str, key: str) -> str | None:
    found = spark.sql(f"SHOW TBLPROPERTIES {ledger.physical(database, name)}").collect()
    return {r["key"]: r["value"] for r in found}.get(key)


def merges(spark: SparkSession, database: str) -> bool:
    """Whether the warehouse merges survivors across loads (catalog metadata only)."""
    there = (n for n in ledger.MERGEABLE if spark.catalog.tableExists(ledger.physical(database, n)))
    return any(_property(spark, database, n, "merge_parts") for n in there)


def drop_all(spark: SparkSession, database: str, tables=None) -> None:
    """Drop tables if they are there, dependents first (K3)."""
    names = [n for n in reversed(tables or CREATE_ORDER) if spark.catalog.tableExists(ledger.physical(database, n))]
    if names:  # what earlier loads published of them is gone
        ledger.publish(spark, database, [ledger.Entry(n, None, None, True) for n in names])
    for name in names:
        spark.sql(f"DROP VIEW IF EXISTS {database}.{name}")
        spark.sql(f"DROP TABLE IF EXISTS {ledger.physical(database, name)}")


def length_violations(df: DataFrame, table: Table) -> F.Column:
    """Boolean column: some value is longer (in bytes) than declared."""
    cond = F.lit(False)
    for c in table.columns:
        if c.max_len is not None:
            cond = cond | F.coalesce(F.octet_length(F.col(c.name)) > c.max_len, F.lit(False))
    return cond


def conform(df: DataFrame, table: str | Table, id_offset: int = 0, keep: Sequence[str] = ()) -> DataFrame:
    """Cast to the registered schema (and carry ``keep`` along); add the surrogate id
    if the table has one."""
    t = TABLES[table] if isinstance(table, str) else table
    if t.identity and t.identity not in df.columns:
        df = with_row_id(df, t.identity, id_offset)
    return df.select(*[safe_cast(F.col(c.name), c.type).alias(c.name) for c in t.columns], *keep)


def current_max_id(spark: SparkSession, database: str, table: Table, but: str | None = None) -> int:
    """Largest surrogate id already stored (0 for an empty table), published or
    not, but for the load ``but`` (which is being written again)."""
    if not table.identity:
        return 0
    stored = spark.table(ledger.physical(database, table.name))
    if not stored.inputFiles():  # file listing only: a new table costs no job
        return 0
    if but is not None:
        stored = stored.where(F.col("load_id") != but)
    row = stored.agg(F.max(table.identity)).first()  # footer stats with aggregate pushdown
    return int(row[0] or 0)


def reject_reasons(df: DataFrame, table: Table) -> F.Column:
    """Why the warehouse would refuse a row: values that fail the cast to their
    declared type, or are longer than declared; null for good rows (K4)."""
    reasons = []
    for c in table.columns:
        if c.name not in df.columns:
            continue
        value = F.col(c.name)
        if df.schema[c.name].dataType != c.type:
            failed = value.isNotNull() & safe_cast(value, c.type).isNull()
            reasons.append(F.when(failed, F.lit(f"{c.name}: not {_spark_type_ddl(c.type)}")))
        if c.max_len is not None:
            reasons.append(F.when(F.octet_length(value.cast("string")) > c.max_len, F.lit(f"{c.name}: over {c.max_len} bytes")))
    return F.nullif(F.concat_ws("; ", *reasons), F.lit("")) if reasons else F.lit(None).cast("string")


def write_rejects(rejects: DataFrame, database: str, name: str, load_id: str) -> None:
    """Keep ``(reason, row)`` of a load's refused rows of one table, in place of what
    it had kept before."""
    spark = rejects.sparkSession
    view = f"nm_rejects_{load_id}_{name}"
    rejects.select("reason", "row").createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {database}.{ledger.REJECTS} PARTITION (load_id = '{load_id}', table_name = '{name}') SELECT reason, row FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
    spark.catalog.refreshTable(f"{database}.{ledger.REJECTS}")


def stage_table(df: DataFrame, database: str, name: str, load_id: str, mode: str = "append") -> list[Entry]:
    """Conform and write one table's rows of a load (K1), not yet published.

    Good rows go to the table, rows it would refuse to the reject table; both
    are counted (A2) by the job that writes the good ones.  Bridge ids continue after the
    stored maximum, so a second batch never reuses an id.
    """
    if name in ledger.EXTRA:
        return _stage_ratings(df, database, name, load_id, mode)
    spark = df.sparkSession
    t = TABLES[name]
    if name in ledger.MERGEABLE and (n_parts := _property(spark, database, name, "merge_parts")):
        return _stage_merged(df, database, name, load_id, mode, int(n_parts))
    checked = df.withColumn("__nm_reject", reject_reasons(df, t))
    offset = current_max_id(spark, database, t, load_id) if t.identity else 0
    conformed = conform(checked, t, offset, keep=["__nm_reject"])
    buckets = bucket_count(spark, database, name)
    if buckets:
        # one file per bucket per write, instead of one per task and bucket
        conformed = conformed.repartition(buckets, movie_key(name))
    counted = Observation(f"rows_{name}_{load_id}")
    good = F.col("__nm_reject").isNull()
    conformed = conformed.observe(counted, F.count_if(good).alias("rows"), F.count_if(~good).alias("rejected"))
    ledger.insert(conformed.where(good).drop("__nm_reject"), database, name, load_id)
    rows, rejected = (int(counted.get.get(k, 0)) for k in ("rows", "rejected"))
    if rejected:
        bad = checked.where(~good).select(F.col("__nm_reject").alias("reason"), F.to_json(F.struct(*df.columns)).alias("row"))
        write_rejects(bad, database, name, load_id)
    return [Entry(name, load_id, None, mode == "overwrite", rows, rejected)]


def _stage_ratings(df: DataFrame, database: str, name: str, load_id: str, mode: str) -> list[Entry]:
    """Merge rating statistics into the parts of ``fact_rating`` that they touch.

    ``df`` has the fact's columns, with ``rating_total`` and ``rating_values`` (sum and
    number of ratings) or without (then taken from average and count).  A part is
    a hash of the movie id; the new version of a touched part is its live rows
    and the batch, other parts are not read or written.
    """
    spark = df.sparkSession
    n_parts = int(_property(spark, database, name, "rating_parts"))
    if "rating_total" not in df.columns:
        n = F.col("ratings_count").cast("bigint")
        df = df.withColumns({"rating_total": F.col("ratings_average").cast("double") * n, "rating_values": n})
    sums = ["ratings_count", "rating_total", "rating_values"]
    kept = ["movie_id", *sums, "min_rate", "max_rate"]
    batch = df.select(*kept).withColumn("part", F.pmod(F.hash("movie_id"), F.lit(n_parts)))
    path = scratch_path(spark, "rating-batch")
    parts = Observation(f"parts_{name}_{load_id}")
    batch.observe(parts, F.collect_set("part").alias("parts")).write.parquet(path)  # at most n_parts values
    batch = spark.read.schema(batch.schema).parquet(path)
    touched = sorted(parts.get.get("parts") or [])
    if not touched:
        return [Entry(name, load_id, None, mode == "overwrite")]
    if mode == "append":
        seen = ledger.predicate(ledger.live(ledger.entries(spark, database)).get(name))
        stored = spark.table(ledger.physical(database, name)).where(seen).where(F.col("part").isin(touched))
        batch = batch.unionByName(stored.select(*kept, "part"))
    merged = batch.groupBy("part", "movie_id").agg(*[F.sum(c).alias(c) for c in sums], F.min("min_rate").alias("min_rate"), F.max("max_rate").alias("max_rate"))
    merged = with_audit(merged.withColumn("ratings_average", F.col("rating_total") / F.nullif(F.col("rating_values"), F.lit(0))))
    columns = TABLES[name].columns
    extra = [F.col(c).cast(k).alias(c) for c, k in ledger.EXTRA[name].items()]
    out = merged.select(*[safe_cast(F.col(c.name), c.type).alias(c.name) for c in columns], *extra, "part")
    buckets = bucket_count(spark, database, name)
    out = out.repartition(buckets, movie_key(name)) if buckets else out.hint("rebalance", "part")
    out, rows = observed(out, f"rows_{name}_{load_id}")
    ledger.insert(out, database, name, load_id)
    remove_scratch(spark, path)
    new = [Entry(name, load_id, p, True, int(rows.get.get("rows", 0)) if p == touched[0] else 0) for p in touched]
    return [Entry(name, None, None, True), *new] if mode == "overwrite" else new


def _least(df: DataFrame, t: Table, key: str) -> DataFrame:
    """Per key the least row: by its order key if the table has one, then by the columns
    in declared order (nulls first), the audit column last.  Any split of
    the rows into loads gives the same row."""
    order = ([ledger.ORDER_KEY[t.name]] if t.name in ledger.ORDER_KEY else []) + [c for c in t.column_names if c not in (key, "last_updated")]
    order += [c for c in t.column_names if c == "last_updated"]
    least = df.groupBy("part", key).agg(F.min(F.struct(*order)).alias("__nm_row"))
    kept = [*t.column_names, *([ledger.ORDER_KEY[t.name]] if t.name in ledger.ORDER_KEY else [])]
    return least.select(key, "__nm_row.*", "part").select(*kept, "part")


def _stage_merged(df: DataFrame, database: str, name: str, load_id: str, mode: str, n_parts: int) -> list[Entry]:
    """Merge a load's rows of a table of one row per key with the stored ones.

    ``df`` may hold many rows of a key.  Rows that the table would refuse go to the
    reject table and do not take part.  The load's least rows are put down once,
    then merged with the live rows of the parts they touch; other parts are not
    read or written.  Both steps combine map-side, so a hot key arrives as one row
    per task.
    """
    spark = df.sparkSession
    t, key = TABLES[name], ledger.MERGEABLE[name]
    extra = [ledger.ORDER_KEY[name]] if name in ledger.ORDER_KEY else []
    if extra and extra[0] not in df.columns:
        df = df.withColumn(extra[0], F.md5(F.to_json(F.struct(*[c for c in df.columns if c != "last_updated"]))))
    checked = df.withColumn("__nm_reject", reject_reasons(df, t))
    good = F.col("__nm_reject").isNull()
    counted, parts = Observation(f"rejected_{name}_{load_id}"), Observation(f"parts_{name}_{load_id}")
    conformed = conform(checked, t, keep=[*extra, "__nm_reject"]).observe(counted, F.count_if(~good).alias("rejected"))
    batch = _least(conformed.where(good).drop("__nm_reject").withColumn("part", F.pmod(F.hash(key), F.lit(n_parts))), t, key)
    path = scratch_path(spark, f"merge-{name}")
    batch.observe(parts, F.collect_set("part").alias("parts")).write.parquet(path)  # at most n_parts values
    batch = spark.read.schema(batch.schema).parquet(path)
    touched = sorted(parts.get.get("parts") or [])
    rejected = int(counted.get.get("rejected", 0))
    if rejected:
        bad = checked.where(~good).select(F.col("__nm_reject").alias("reason"), F.to_json(F.struct(*df.columns)).alias("row"))
        write_rejects(bad, database, name, load_id)
    if not touched:
        remove_scratch(spark, path)
        return [Entry(name, load_id, None, mode == "overwrite", 0, rejected)]
    if mode == "append":
        seen = ledger.predicate(ledger.live(ledger.entries(spark, database)).get(name))
        stored = spark.table(ledger.physical(database, name)).where(seen).where(F.col("part").isin(touched))
        batch = _least(batch.unionByName(stored.select(*batch.columns)), t, key)
    buckets = bucket_count(spark, database, name)
    out = batch.repartition(buckets, key) if buckets else batch.hint("rebalance", "part")
    out, rows = observed(out, f"rows_{name}_{load_id}")
    ledger.insert(out, database, name, load_id)
    remove_scratch(spark, path)
    new = [Entry(name, load_id, p, True, *((int(rows.get.get("rows", 0)), rejected) if p == touched[0] else (0, 0))) for p in touched]
    return [Entry(name, None, None, True), *new] if mode == "overwrite" else new


def last_seq(spark: SparkSession, database: str) -> int:
    """Where the ledger stands; pass it to ``ledger.publish`` of what is built on it."""
    return max((r["seq"] for r in ledger.entries(spark, database)), default=0)


def write_table(
    df: DataFrame,
    database: str,
    name: str,
    mode: str = "append",
) -> int:
    """Write one target table as a load of its own; returns the rows written."""
    spark = df.sparkSession
    until = last_seq(spark, database)
    new = stage_table(df, database, name, ledger.new_load_id(), mode)
    ledger.publish(spark, database, new, until if mode == "append" else None)
    return sum(e.rows for e in new)


def write_all(frames: Mapping[str, DataFrame], database: str, mode: str = "append") -> dict[str, int]:
    """Write the given frames in creation order; returns rows per table."""
    return {name: write_table(frames[name], database, name, mode) for name in CREATE_ORDER if name in frames}


def refresh_all(spark: SparkSession, database: str, tables=None) -> None:
    """Drop cached file listings of the warehouse tables in this session and
    renew the views (another session, e.g. a stream's, may have published)."""
    spark.catalog.refreshTable(f"{database}.{ledger.LEDGER}")
    spark.catalog.refreshTable(f"{database}.{ledger.REJECTS}")
    names = [n for n in (CREATE_ORDER if tables is None else tables) if spark.catalog.tableExists(ledger.physical(database, n))]
    for name in names:
        spark.catalog.refreshTable(ledger.physical(database, name))
    ledger.refresh_views(spark, database, names, ledger.live(ledger.entries(spark, database)))


def read_all(spark: SparkSession, database: str, tables=None) -> dict[str, DataFrame]:
    """Published rows of all tables as of one look at the ledger."""
    seen = ledger.live(ledger.entries(spark, database))
    return {n: ledger.read(spark, database, n, seen) for n in (CREATE_ORDER if tables is None else tables)}


def conform_report(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows that break a declared length (``violations``) and values
    that are there but fail the cast to the declared type, which ``conform``
    stores as null (``failed_casts``) (K4)."""
    parts = []
    for name, df in frames.items():
        t = TABLES[name]
        failed = [F.count_if(F.col(c.name).isNotNull() & safe_cast(F.col(c.name), c.type).isNull()) for c in t.columns if c.name in df.columns]
        counts = df.agg(F.count_if(length_violations(df, t)).alias("violations"), sum(failed, F.lit(0)).alias("failed_casts"))
        parts.append(counts.select(F.lit(name).alias("table"), "violations", "failed_casts"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
