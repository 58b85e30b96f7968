"""Times the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

Each query is built and run to the end, its rows thrown away, after one untimed run of the flagship query
that starts the engine.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from emberlake.plans.catalog import QUERIES  # noqa: E402
from emberlake.session import local_session  # noqa: E402

HEADLINE = [
    "points_in_areas",
    "points_in_states",
    "fires_table",
    "areas_within_distance",
    "nearest_k_stations",
    "stations_table",
    "weather_by_area",
    "hierarchy_pivot",
    "fire_clean",
    "weather_clean",
    "weekly_sum",
    "weekly_avg",
    "rolling_sums_weekly_max",
    "weekly_joined",
    "rolling_correlation",
    "monthly_counts",
    "region_month_pivot",
    "area_month_counts_zero_filled",
    "stations_with_data",
    "quality_checks",
    "dynamic_overwrite_roundtrip",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=8, memory=os.environ.get("BENCH_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, HEADLINE[0], sf_dir)
    seconds = {name: run(spark, name, sf_dir) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
