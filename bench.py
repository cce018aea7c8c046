"""Warm wall times of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_QUERIES (comma-separated names, or "all") select what runs.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from terraloom.plans import registered
from terraloom.session import build_session

HEADLINE = (
    "season_stats season_range_join season_grid gdd_rain_cv rolling_90 gamma_fit spi_index weather_features rate_audit "
    "clean_master hash_encode_256 collision_audit dedup_keep_first upsert_new_wins latest_checkpoint checkpoint_summary "
    "enrich_incremental first_match_lookup widen_seasons attach_row_ids frame_diff sample_grid bbox_overlap links_extract "
    "crawl_depth select_tiles onehot onehot_inverse sparse_slots forward_noise recover_noise mse denoise box_summary bin_scatter "
    "retry_missing season_files drained_weather mixed_headers bbox_overlap_mixed nearest_sample homolosine_bounds tree_diff "
    "sparse_roundtrip scatter_sample versioned_saves"
).split()
RUNS = 3


def calibrate(spark) -> float:
    """Seconds of a fixed piece of work that reads no table, so that runs on different machines can be compared."""
    from pyspark.sql import functions as F

    start = time.perf_counter()
    spark.range(0, 200_000_000, 1, 8).select(F.sum(F.xxhash64("id").bitwiseAND(1023))).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def run_once(spark, run, sf_dir: str) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else None)
    spark.sparkContext.setLogLevel("ERROR")
    entries = registered()
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(entries) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    for name in names:  # warm the compiler with the whole set, so the first query is not charged for it
        run_once(spark, entries[name][0], sf_dir)
    calibration = round(statistics.median(calibrate(spark) for _ in range(RUNS)), 3)
    seconds = {}
    for name in names:
        run = entries[name][0]
        seconds[name] = round(statistics.median(run_once(spark, run, sf_dir) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")), "calibration_seconds": calibration,
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
