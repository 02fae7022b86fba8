"""Times the headline queries: one warm-up on smaller data, then one timed run each.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from zonepulse.plans import CATALOG  # noqa: E402

HEADLINE = [
    "a01_zone_volume_taxi", "a04_zone_traffic_daily", "a05_temporal_profile_subway",
    "a06_temporal_profile_green_taxi", "a07_temporal_profile_citibike",
    "c01_clean_yellow", "c04_clean_bikes", "c05_clean_subway", "c06_clean_events_strict",
    "c07_clean_events_multiformat", "x05_type_and_partition_trips", "k01_write_curated",
    "j02_match_zone_by_name", "j03_assign_zone_by_point",
    "p01_profile_yellow", "p10_profile_bikes", "p11_profile_events", "p14_audit_location_ids",
    "e02_event_actual", "e04_daily_baseline_taxi", "e07_baseline_average", "e08_event_impact",
    "e09_sample_midweek_events", "e10_sampled_impact_taxi", "e11_sampled_impact_subway",
    "e12_sampled_impact_citibike", "e13_event_transit_summary",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("zonepulse-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    CATALOG[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = session(cpus)
    small = os.path.join(os.path.dirname(sf_dir), "sf0.01")
    for name in names:
        run(spark, name, small if os.path.isdir(small) else sf_dir)
    times = {name: run(spark, name, sf_dir) for name in names}
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
