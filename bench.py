"""Headline queries, timed: one JSON line. $BENCH_SF_DIR, $BENCH_CPUS, $BENCH_QUERIES (comma-separated)."""

import json
import os
import time

from pyspark.sql import SparkSession

from tidemark.plans import catalogue

HEADLINE = [
    "bottom_up_metrics", "cohort_metrics", "rollup_levels", "dense_store_panel", "price_edp", "ar_features", "parent_choice", "cumulative_metrics",
    "weekly_resample", "bottom_up_series", "global_leaf_ranking", "residual_taxonomy", "gamma_strength", "holiday_offsets_pivot", "simple_ses_fold", "rls_node_forecast", "leaf_ses_forecast", "multi_cadence_forecast",
]


def main() -> None:
    cpus, sf_dir = os.environ.get("BENCH_CPUS", "8"), os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    os.environ.setdefault("OMP_NUM_THREADS", "1")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    catalogue.QUERIES["section_bounds"](spark, sf_dir).collect()
    seconds = {}
    for name in names:
        began = time.perf_counter()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
