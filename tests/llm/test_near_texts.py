"""The near-dedup stage of the pipeline shuffles no texts while few rows go."""

import random

import corpus_pipeline


def test_texts_of_rows_that_stay_are_not_shuffled(spark):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(500, texts[7]), (501, texts[7] + " more"), (9, texts[9]), (9, "another text of the same id"), (None, texts[3]), (None, None), (502, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")  # so small that a list is broadcast for its known size only
    try:
        left = corpus_pipeline.near_dedup(spark, docs, "")
        plan = left._jdf.queryExecution().executedPlan().toString()
        kept = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in left.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 4, plan
    want = [(i, t) for i, t in enumerate(texts)] + [(9, "another text of the same id"), (502, None), (None, texts[3]), (None, None)]
    assert kept == sorted((i is None, i or 0, t or "") for i, t in want)
