"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [os.path.dirname(os.path.abspath(__file__)), os.environ.get("PYTHONPATH")]))

from cinderspark.plans import registry  # noqa: E402
from cinderspark.session import local_session  # noqa: E402

HEADLINE = (
    "regional_stats_nation", "regional_stats_tract", "regional_stats_rollup", "fire_weather_histogram", "incident_window", "gap_fill", "conv_masked_3", "pyramid_levels",
    "wind_informed_bp", "spatial_join_boxes", "point_in_polygon", "sample_nearest", "kendall_tau_c", "percentiles", "hotspots_high",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    spark = local_session(cpus, shuffle_partitions=cpus, memory=os.environ.get("BENCH_MEMORY", "8g"))
    spark.sparkContext.setLogLevel("ERROR")
    found, took = registry.queries(), {}
    registry.queries()[HEADLINE[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()  # the first query compiles
    for name in HEADLINE:
        start = time.perf_counter()
        found[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
