"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query's result is fully computed through the ``noop`` sink (no driver
collection of large results).  A small warm-up query runs first so JVM
start-up is not charged to the first query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "profile_column_summary",
    "profile_describe",
    "correlation_matrix",
    "analyze_columns_orders",
    "issues_summary",
    "validate_dataset",
    "missing_actions",
    "knn_impute",
    "drop_duplicates",
    "handle_outliers",
    "date_parts",
    "encode_all",
    "scale_standard",
    "bin_equal_freq",
    "mutual_info",
    "table_digest",
    "audit_chain",
    "fingerprint_similarity",
    "full_prep",
    "basic_prep",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from prepspark.catalog import queries
    from prepspark.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) * 2), app="prepspark-bench")
    qs = queries()
    qs["profile_shape"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as exc:  # noqa: BLE001 - a failing query is reported, the bench goes on
            times[name] = None
            print(f"# {name} failed: {exc}", file=sys.stderr)
    ok = [v for v in times.values() if v is not None]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(ok), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
