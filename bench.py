"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from readloom.plans import fixtures, registry  # noqa: E402
from readloom.session import build_session  # noqa: E402

HEADLINE = [
    "ag7_separation_report", "jn1_costar_edges", "ss1_sliding_counts", "ss2_sliding_reduce", "ss3_hashtag_trends",
    "wn1_balance_load", "wn2_ordinal", "wn3_sort_violations", "sr3_coordinate_sort", "ag9_merge_intervals",
    "jn4_intersect_intervals", "jn9_mate_join", "ag11_reference_stats", "ag12_bin_counts", "ag13_window16k_coverage",
    "ag18_validation_report", "ag19_mismatch_summary", "ag20_mark_duplicates", "ag21_recalibration_table",
    "ag22_indel_targets", "ag14_variant_compare", "sr6_variant_sort", "jn13_zip_by_position", "io4_read_sam",
]
# timed and listed too, but not part of the total, which stays comparable from run to run
FURTHER = ["sf14_reconstruct_reference", "ag2_adjacency", "ag21_recalibrated_reads", "ag22_realignment_targets",
           "jn5_stored_targets", "ss4_topk_stream"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()
    names = sys.argv[1:] or HEADLINE + FURTHER
    fixtures.table(spark, sf_dir, "region").collect()  # start the executors
    times = {}
    for name in sorted(fixtures.STORED):  # the inputs the queries share are timed on their own
        start = time.perf_counter()
        fixtures.fixture(spark, sf_dir, name)
        times[f"prepare_{name}"] = round(time.perf_counter() - start, 3)
    for name in names:
        start = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    further = sum(times.get(name, 0) for name in FURTHER)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()) - further, 3), "unit": "sec",
                      "further_total": round(further, 3), "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
