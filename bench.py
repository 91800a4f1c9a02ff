"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "silver_strict", "clean_waterfall", "silver_adaptive", "gold_demand", "dense_grid_city", "features_main", "features_evening",
    "historical_baselines", "sequence_samples", "forecast_table", "metrics_by_hour", "late_affine_search", "hour_routed_forecast",
    "sales_silver", "mart_customers", "mart_products", "mart_months", "exact_quantiles_by_type", "day_forecast_recursive",
    "stream_hourly_demand",
]


def main() -> None:
    from zonecast.plans.catalog import queries
    from zonecast.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = tempfile.mkdtemp(prefix="zonecast-bench-")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.checkpoint.dir": folder, "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    # One small query first, so that starting the engine is not counted.
    registered["hourly_demand"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline queries, total time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()
    shutil.rmtree(folder, ignore_errors=True)


if __name__ == "__main__":
    main()
