"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import suite.all  # noqa: E402, F401
from suite import base  # noqa: E402
from zonaria.session import build_session  # noqa: E402

HEADLINE = (
    "E1_comuna_quality", "D5_D7_partition_with_risk", "K2_pair_areas", "D10_building_comuna", "E6_occupation_by_zone", "D1_points_in_zones", "D8_nearest_within_50m",
    "D23_parcel_at_point", "D24_E12_polygon_cards", "E7_calculated_volume_shared", "C16_clean_parcels", "E10_parcel_statistics", "I1_norm_text", "C6_C7_C8_C9_source_fields",
    "D19_registry_families", "D13_best_match", "N1_N2_theme_sampling", "N6_hillshade",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    spark = build_session(f"local[{cpus}]", max(8, cpus))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        base.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
