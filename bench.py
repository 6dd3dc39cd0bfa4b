"""Times the headline queries once each after a warm-up; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from orrery.plans import catalog
from orrery.session import local_session

NAMES = ["lazy_manifest", "window_box_overlap", "lazy_annotations", "box_geometry", "image_mass_counts", "crop_size_fit", "annotation_fit_summary", "coco_size_stats", "describe_by_group", "group_split_hash", "positive_ratio", "online_balance", "cadence_schedule", "pairwise_distance", "profile_shift_ncc", "manifest_diff"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    took = {}
    for name in NAMES:
        began = time.perf_counter()
        catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
