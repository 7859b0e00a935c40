"""Benchmark: the warehouse load and the questions at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Steps (each timed):

1. ``catalog_csv``  derive the movie-style catalog from the supplied tables and
   write it as CSV source files (input preparation, not part of the metric);
2. ``load``         the full load: four prefix scans, staged movies, 17
   tables written as Parquet, then the quality gate (53 rules) enforced;
3. ``b1`` .. ``b5`` the five questions over the stored warehouse;
4. operator probes over the base tables (written to the no-op sink).

Before timing, the same steps run once on the smallest supplied scale
(``warmup``, reported but not part of the metric): the first run of each plan
pays JVM class loading and code generation, which a long-running cluster
pays once and which would otherwise dominate small local timings.

Prints one JSON line; ``value`` is ``load`` plus the five questions.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from nestmart.plans import catalog, load, quality, questions, registry  # noqa: E402
from nestmart.session import build_session, scratch_path  # noqa: E402
from nestmart.sinks import warehouse as sink  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app_name="nestmart-bench")
    sf = sf_dir.rsplit("sf", 1)[-1]
    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        return out

    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir) and warm_dir != sf_dir:
        def warmup():
            wroot = scratch_path(spark, "bench-warmup")
            wpre = load.write_sources(catalog.derive_catalog(spark, warm_dir), f"{wroot}/landing")
            wdb = "nm_warm_" + wroot.rsplit("-", 1)[-1][:12]
            quality.enforce(load.run_load(spark, wpre, wdb, f"{wroot}/warehouse"))
            ww = sink.read_all(spark, wdb)
            questions.question_b5(ww, registry.B5_FIRST, registry.B5_LAST).collect()

        timed("warmup", warmup)

    root = scratch_path(spark, "bench")
    prefixes = timed("catalog_csv", lambda: load.write_sources(catalog.derive_catalog(spark, sf_dir), f"{root}/landing"))

    db = "nm_bench_" + root.rsplit("-", 1)[-1][:12]
    timed("load", lambda: quality.enforce(load.run_load(spark, prefixes, db, f"{root}/warehouse")))
    w = sink.read_all(spark, db)

    r = registry
    asks = {
        "b1": lambda: questions.question_b1(w, r.B1_YEAR, r.B1_LANGUAGE),
        "b2": lambda: questions.question_b2(w, r.B2_FIRST, r.B2_LAST),
        "b3": lambda: questions.question_b3(w, r.B3_COUNTRY, r.B3_GENRE, r.B3_FIRST, r.B3_LAST),
        "b4": lambda: questions.question_b4(w, r.B4_GENRE, r.B4_YEAR),
        "b5": lambda: questions.question_b5(w, r.B5_FIRST, r.B5_LAST),
    }
    for name, ask in asks.items():
        timed(name, lambda ask=ask: ask().write.format("noop").mode("overwrite").save())

    probes = ["json_bridge", "json_pyliteral", "dedup_ordered", "group_stats", "surrogate_key", "fk_orphans", "pk_violations", "lookup_name"]
    for name in probes:
        timed(name, lambda name=name: r.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    value = round(timings["load"] + sum(timings[b] for b in asks), 3)
    print(json.dumps({"metric": "warehouse_load_plus_questions", "value": value, "unit": "sec", "queries": timings, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
