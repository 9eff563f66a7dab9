"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores,
``BENCH_QUERIES`` a comma-separated choice.  Every result is computed in full.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from recordloom.session import drop_staged, local_session  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINE = (
    "standardize_flat standardize_nested link_exact link_fuzzy link_two_strategy merge_two_sources "
    "id_mapping identity_dim statistics address_hashes text_digests proximity_join address_clusters "
    "address_dim row_numbering rank_in_group snapshot_intervals scd2_update succession relocations "
    "null_rates test_suite relationships_failures delimited_round_trip run_log "
    "gold_current gold_documents_flattened review_queue confidence_tiers whole_run pipeline_metrics quality_report "
    "history_documents link_repeated_name delimited_files_of_two_headers json_array_read materialized_kinds "
    "link_fuzzy_indexed address_clusters_by_batches"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    # Start the JVM, the Python workers and the file readers before the clock.
    QUERIES["jaro_winkler_scores"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
        drop_staged(spark)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
