"""Source options that need no running database or object store."""

from __future__ import annotations

import os

import pytest

from nestmart.schemas import KEYWORDS_SCHEMA
from nestmart.sources import jdbc_options, read_prefix

from .conftest import write_text


def test_jdbc_striped_options():
    opts = jdbc_options("jdbc:postgresql://h:5432/db", "dwh.dim_movies", user="u", password="p",
                        partition_column="id", lower_bound=1, upper_bound=1_000_000, num_partitions=64)
    assert opts["partitionColumn"] == "id" and opts["numPartitions"] == "64"
    assert opts["lowerBound"] == "1" and opts["upperBound"] == "1000000"
    assert opts["dbtable"] == "dwh.dim_movies" and opts["fetchsize"] == "10000"


def test_jdbc_striping_needs_bounds():
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")


def test_prefix_matches_siblings_and_subfolders_not_others(spark, tmp_root):
    body = "id,keywords\n{}, \"[]\"\n"
    write_text(os.path.join(tmp_root, "kw.csv"), body.format(1))
    write_text(os.path.join(tmp_root, "kw_extra.csv"), body.format(2))
    write_text(os.path.join(tmp_root, "kw", "deep", "part.csv"), body.format(3))
    write_text(os.path.join(tmp_root, "other.csv"), body.format(4))
    df = read_prefix(spark, os.path.join(tmp_root, "kw"), KEYWORDS_SCHEMA)
    assert sorted(r.id for r in df.collect()) == [1, 2, 3]


def test_csv_binds_by_position_and_nulls_only_bad_fields(spark, tmp_root):
    from pyspark.sql import types as T

    from nestmart.sources import read_csv

    # header names differ from the schema: columns still bind by position
    path = write_text(os.path.join(tmp_root, "r", "a.csv"), "x,y,z\n1,81.0,ok\nnope,7,fine\n")
    schema = T.StructType([
        T.StructField("id", T.IntegerType()), T.StructField("runtime", T.IntegerType()), T.StructField("title", T.StringType()),
    ])
    rows = sorted((tuple(r) for r in read_csv(spark, path, schema).collect()), key=repr)
    # '81.0' is no int (null), 'nope' is no int (null); the rest of each row is kept
    assert rows == sorted([(1, None, "ok"), (None, 7, "fine")], key=repr)


def test_prefix_takes_glob_characters_literally(spark, tmp_root):
    from pyspark.sql import types as T

    from nestmart.sources import read_prefix

    schema = T.StructType([T.StructField("id", T.LongType())])
    write_text(f"{tmp_root}/kw[1]/a.csv", "id\n1\n8589934592\n")
    write_text(f"{tmp_root}/kw1/b.csv", "id\n7\n")
    assert sorted(r.id for r in read_prefix(spark, f"{tmp_root}/kw[1]", schema).collect()) == [1, 1 << 33]


def test_dense_ids_with_payload_and_scratch_rule(spark):
    from pyspark.sql import functions as F

    from nestmart import operators as ops

    df = spark.range(5000).select(F.xxhash64("id").alias("k"), F.concat(F.lit("x"), "id").alias("text")).repartition(5)
    ids = ops.with_dense_id(df, ["k"], "n").toPandas().sort_values("k")
    assert ids["n"].tolist() == list(range(1, 5001))
