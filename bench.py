"""Time the headline queries on one folder of driver tables and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 2) and
BENCH_QUERIES (comma-separated names, or `all` for every registered query). Each query runs once
to warm up and then BENCH_RUNS times; the median is kept. Results are written to the no-op sink, so every row and
column is computed. Row counts come from the warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tablebridge.plans import catalog
from tablebridge.session import local_session


HEADLINE = [
    "scan_text", "be_to_timestamp", "align_to_schema", "field_issues", "first_by_key", "distinct_on",
    "lookup_preferred", "null_invalid_fk", "ensure_parent", "find_or_create_entity", "match_by_name_phone",
    "asof_before_day", "pair_renamed", "merge_insert_only", "merge_if_changed", "column_policy_merge",
    "replace_keep_id", "replace_children", "child_count_summary", "group_to_struct_array", "max_per_column",
    "sum_check", "keyset_page", "boundary_tie_audit", "top_n_history", "multiset_missing", "compare_by_key",
    "hash_overlap", "build_snapshot_doc", "extract_refs", "walk_json_paths", "incremental_append",
    "catch_up_late", "load_appointments", "load_examinations", "load_billing", "load_findings",
    "prior_result_enrichment", "report_history",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(catalog.QUERIES) if asked == "all" else [n for n in asked.split(",") if n] or HEADLINE
    spark = local_session(cpus, cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds, rows, failed = {}, {}, {}
    for name in names:
        try:
            rows[name] = catalog.QUERIES[name](spark, folder).count()
            times = []
            for _ in range(runs):
                start = time.perf_counter()
                catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - start)
            seconds[name] = round(statistics.median(times), 3)
        except Exception as e:  # noqa: BLE001
            failed[name] = str(e)[:200]
        print(f"{name}: {seconds.get(name)}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows": rows,
                "failed": failed,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
