"""Times the headline queries: BENCH_SF_DIR (default sf0.1) on local[BENCH_CPUS]. Prints one line of JSON."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from rooftop.plans import queries

HEADLINES = ["bbox_candidates", "pair_metrics", "strong_pairs", "connected_components", "component_table", "height_selection", "dense_area", "eco_risk", "frontend_layer", "iqr_flags", "rank_pct", "exact_quantiles", "knn_features", "radius_neighbors", "dedupe_source", "norm_text", "tile_index"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).groupBy().count().collect()  # starts the JVM's pools
    took = {}
    for name in HEADLINES:
        began = time.time()
        queries.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
        print(name, took[name], file=sys.stderr)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
