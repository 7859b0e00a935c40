"""Training-data pipeline over ``documents``: STAGES in order, each written as
Parquet and read again as the next one's input.

Cases: null and empty texts fail the quality rules and go; rows are judged one by
one there, also those that share a doc_id or have none; of rows that repeat a doc_id
and text one stays after near dedup; an empty table gives an empty result; further
columns, whatever their names, are carried up to packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestmart.llm import decontaminate, line_dedup, order_minhash, packing, perplexity
from nestmart.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return perplexity.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(docs, *line_dedup.find_lines(docs, links=False))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least doc_id of each group stays.  Rows that repeat a doc_id with the same text
    are copies, too: one of them stays; rows without doc_id stand alone and stay."""
    classes = order_minhash.near_duplicates(docs)
    gone = classes.groupBy("doc_id").agg(F.max(F.col("class_id") == F.col("doc_id")).alias("kept")).where("not kept").select("doc_id")
    again = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n_rows")).where("n_rows > 1").select("doc_id")
    # stored, so that Spark knows how few they are before it deals out the texts: short lists are broadcast and only rows of
    # repeated ids are shuffled with their texts
    gone, again = stored(gone, "pipeline-gone"), stored(again, "pipeline-again")
    left = docs.join(gone, "doc_id", "left_anti")
    return left.join(again, "doc_id", "left_anti").unionByName(left.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: The language model and the alignments have no SQL form; tests hold run()
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
