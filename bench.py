"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.plans import registry  # noqa: E402

HEADLINES = ["k5_robust_outlier", "f6_rolling_robust", "d7_asof_join", "d8_asof_lags", "j1_merge_upsert", "j3_vintage_load", "e10_market_hours_coverage", "f5_gaps", "e16_ohlc_bars", "e11_staleness_rollup", "j7_clean", "d12_window_match", "n1_semantic_search", "k3_distribution"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("k1_check_suite", "e26_burst_ratio"):  # starts the JVM's and the Python workers
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    took = {}
    for name in HEADLINES:
        began = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": Path(sf_dir).name}))


if __name__ == "__main__":
    main()
