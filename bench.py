"""Times the headline queries once each and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose input and cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from evalspark.plans import QUERIES  # noqa: E402

HEADLINE = (
    "e1_scores",
    "e4_group_bootstrap",
    "e5_paired_deltas",
    "e10_slice_report",
    "e13_across_seeds_by_slice",
    "e16_root_coverage",
    "e27_temperature_grid",
    "e29_width_report",
    "e30_listwise_loss",
    "e31_terminal_loss",
    "d1_exclude_seen",
    "d4_overlap_all_rows",
    "d7_schema_alignment",
    "d14_prediction_parity",
    "d16_stored_against_expected",
    "f1_target_gains",
    "f2_distinct_roots",
    "f4_shard_numbers",
    "f5_shortlist",
    "b7_bundle_rules",
    "c12_encode_position",
    "c18_king_relative_ids",
    "e33_sample_summary",
    "u1_batch_scoring",
    "m4_list_ranker",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("evalspark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("sum(id)").collect()
    chosen = [q for q in sys.argv[1:] if q in QUERIES] or HEADLINE
    times = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
