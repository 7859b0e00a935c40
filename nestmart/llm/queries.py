"""Queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from . import decontaminate, fill_middle, langid, line_dedup, order_minhash, packing, perplexity, pii, suffix_dedup, token_align, token_store, toxicity, warc
from .common import table

QUERIES = {
    "op1_order_minhash": lambda spark, d: order_minhash.op1_near_dedup(table(spark, d, "documents")),
    "op2_substring_dedup": lambda spark, d: suffix_dedup.op2_substring_dedup(table(spark, d, "documents")),
    "op3_toxicity": lambda spark, d: toxicity.op3_toxicity(table(spark, d, "documents"), table(spark, d, "labels")),
    "op4_decontaminate": lambda spark, d: decontaminate.op4_decontaminate(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op5_packing": lambda spark, d: packing.op5_packing(table(spark, d, "documents")),
    "op6_line_dedup": lambda spark, d: line_dedup.op6_line_dedup(table(spark, d, "documents")),
    "op7_warc": lambda spark, d: warc.op7_warc(table(spark, d, "pages")),
    "op8_quality_rules": lambda spark, d: perplexity.op8_quality_rules(table(spark, d, "documents")),
    "op9_language_id": lambda spark, d: langid.op9_language_id(table(spark, d, "documents")),
    "op10_pii": lambda spark, d: pii.op10_pii(table(spark, d, "documents")),
    "op11_token_align": lambda spark, d: token_align.op11_token_align(table(spark, d, "documents")),
    "op12_token_store": lambda spark, d: token_store.op12_token_store(table(spark, d, "documents")),
    "op13_fill_middle": lambda spark, d: fill_middle.op13_fill_middle(table(spark, d, "documents")),
}

SQL = {"op6_line_dedup": line_dedup.SQL, "op13_fill_middle": fill_middle.SQL}
