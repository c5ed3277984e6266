"""Time every headline query: one warm-up, then the median of the timed runs.

Once the budget is half spent, queries are timed without warm-up, so that a slow machine still
finishes. The action is a full materialisation into the noop sink. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from lakeloom.session import session

HEADLINE = [
    "metric_by_nation", "metric_by_role", "metric_rollup", "payment_view",
    "join_code", "outcome_group", "key_concat", "row_hashes", "date_parse_formats", "explode_matches",
    "first_by_key", "collapse_duplicates", "describe_numeric", "distribution", "unpivot_amounts", "multiset_difference",
    "lookup_twice", "resolve_code", "unmatched_codes", "as_of_lookup", "outer_indicator", "packed_members",
    "version_suffix", "surrogate_key", "latest_value", "current_flags", "running_total", "fill_forward", "header_carry",
    "calendar_days", "scd2_replay", "audit_counts", "roster_refresh", "catalog_diff",
    "profile", "hash_reconcile", "compare_by_date", "compare_suite", "orphans",
    "claims_silver", "gold_members", "gold_claims", "gold_estimates", "site_dimension", "code_reference",
    "csv_contract", "stream_hourly_counts",
]


BUDGET = float(os.environ.get("BENCH_BUDGET", "900"))


def run(names: list[str], sf_dir: str, cpus: int, runs: int) -> dict[str, float]:
    import workloads

    spark = session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": str(cpus), "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"), "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    begun = time.perf_counter()
    for name in names:
        taken = []
        late = time.perf_counter() - begun > BUDGET / 2
        for i in range(1, 2) if late else range(runs + 1):
            start = time.perf_counter()
            workloads.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    times = run(sys.argv[1:] or HEADLINE, sf_dir, cpus, runs)
    sf = float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"))
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
