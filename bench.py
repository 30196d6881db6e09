"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
``BENCH_REPEAT=n`` runs each query n times and reports the median.
The silver layer (certificates, recommendations join and its rollup, lettings) is built
fresh for the run and timed as ``silver_build``; the other queries read it,
as the reports of the medallion design do. Each query runs its full plan
into Spark's ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "latest_record_per_key", "composite_priority", "top_area_trend", "retrofit_scenarios", "wall_split",
    "area_category_costs", "tier_share_by_area", "top5_types_per_area", "lettings_silver", "affordability_trend",
    "silver_value_counts", "null_audit", "scope_share", "attribution_by_age", "greedy_cover",
    "area_greedy_summary", "quality_report", "multi_hot", "kmeans_tiers",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from hearth.session import get_spark
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    from hearth.plans import layers
    from hearth.plans.catalog import all_queries

    layers.RUN_TAG = uuid.uuid4().hex  # fresh silver for this run
    qs = all_queries()
    wanted = sys.argv[1:] or HEADLINE

    # warm-up (JVM, codegen caches) on a tiny table, not timed
    spark.read.parquet(f"{sf_dir}/nation.parquet").write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    t0 = time.time()
    layers.certificates(spark, sf_dir)
    layers.retrofit_base(spark, sf_dir)
    layers.retrofit_rollup(spark, sf_dir)
    layers.lettings(spark, sf_dir)
    times["silver_build"] = round(time.time() - t0, 3)
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))   # >1: report the median run
    for name in wanted:
        runs = []
        for _ in range(repeat):
            t0 = time.time()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t0)
        times[name] = round(sorted(runs)[len(runs) // 2], 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
