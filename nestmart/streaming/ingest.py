"""Incremental ingest of newly landed source files.

A file-source stream per family with ``trigger(availableNow=True)``: each run
processes the files that arrived since the last run and stops; the streaming
checkpoint (in the shared folder) records which files were taken, so each
file is loaded exactly once, and a failed batch is replayed with the same id.

A micro-batch is a load like any other (``plans.load``): its load id is the
stream's own name (kept beside the checkpoint) and the batch id, its tables are written
under it and published together.  A replayed batch writes the same partitions
anew, or nothing if it was published.  Batch loads and streams may take turns on
one warehouse:

* movies, sales and dimension rows are appended only for keys not published yet;
* nested lists are parsed once per batch;
* bridge rows are appended with ids after the stored maximum;
* ``fact_rating`` keeps sums beside its averages, in parts by a hash of the movie id;
  a batch, or a batch load, writes a new version of the parts it touches.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.values import values_frame
from ..operators.joins import anti_join
from ..plans import load, tables
from ..schemas import QUOTED_SOURCES, SOURCE_SCHEMAS
from ..session import remove_scratch
from ..sinks import ledger
from ..sinks.warehouse import create_all, merges, read_all, refresh_all

_DIM_KEY = {
    "dim_cast": "id",
    "dim_crew": "id",
    "dim_keywords": "id",
    "dim_genres": "id",
    "dim_companies": "id",
    "dim_countries": "iso_code",
    "dim_languages": "iso_code",
}


def _stream_name(spark: SparkSession, path: str) -> str:
    """The stream's own name, written once beside its checkpoint."""
    try:
        kept = spark.read.schema("name string").parquet(path).first()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = None
    if kept is None:
        values_frame(spark, [(uuid.uuid4().hex,)], ["name"]).write.mode("overwrite").parquet(path)
        kept = spark.read.schema("name string").parquet(path).first()
    return kept["name"]


def _new_keys(df: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    known = stored.select(F.col(key).alias("__nm_key")).distinct()
    return df.join(known, F.col(key).eqNullSafe(F.col("__nm_key")), "left_anti")


def process_batch(batch: DataFrame, batch_id: int, family: str, database: str, state_root: str) -> None:
    """Apply one micro-batch of ``family`` rows to the warehouse."""
    spark = batch.sparkSession
    load_id = f"{_stream_name(spark, f'{state_root}/name')}-{batch_id}"
    refresh_all(spark, database)  # other sessions may have published
    if ledger.published(ledger.entries(spark, database), load_id):
        return  # a replay of a batch that went through
    if merges(spark, database):
        staged = load.STAGE[family](batch, tables.MERGED)
        load.new_lists(spark, staged, database)
        load.write_load(spark, staged, database, load_id)
        remove_scratch(spark, *staged.paths)
        return
    if family == "movies_metadata":
        known = read_all(spark, database, ["dim_movies"])["dim_movies"]
        staged = load.stage_movies(batch, narrow=lambda movies: anti_join(movies, known, ["id"]))
    else:
        staged = load.STAGE[family](batch)
    stored = read_all(spark, database, [n for n in staged.frames if n in _DIM_KEY])
    staged.frames.update({n: _new_keys(staged.frames[n], df, _DIM_KEY[n]) for n, df in stored.items()})
    load.write_load(spark, staged, database, load_id)
    remove_scratch(spark, *staged.paths)


def start_ingest(
    spark: SparkSession,
    family: str,
    landing_dir: str,
    database: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start an ``availableNow`` ingest of ``family`` files under ``landing_dir``."""
    create_all(spark, database)
    reader = spark.readStream.schema(SOURCE_SCHEMAS[family]).option("header", "true")
    if family in QUOTED_SOURCES:
        reader = reader.option("quote", '"').option("escape", '"')
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.csv(landing_dir)
    state_root = f"{checkpoint}/state"

    def apply(batch: DataFrame, batch_id: int) -> None:
        # several tables are written from one batch: read its files once
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            process_batch(batch, batch_id, family, database, state_root)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(availableNow=True)
        .start()
    )


def run_ingest(spark: SparkSession, family: str, landing_dir: str, database: str, checkpoint: str) -> None:
    """Process everything that has landed, then return."""
    q = start_ingest(spark, family, landing_dir, database, checkpoint)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    refresh_all(spark, database)
