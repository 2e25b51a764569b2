"""Time the queries: one warm-up run each, then the median of the timed runs.

Prints one JSON line. Settings from the environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS and
BENCH_ONLY (comma-separated names or prefixes; all headline queries without it).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from millrace.plans import all_queries
from millrace.session import local_session

HEADLINE = (
    "c_top_revenue", "c_abandoned", "c_clickpath", "c_item_pivot", "c_clean_users", "c_user_summary", "c_medallion_orders", "c_cdc",
    "c_daily_mean", "j_inner_using", "j_explode_lookup", "j_full_outer", "j_multi_key", "a_agg_alias", "a_count_distinct_tuple",
    "a_pivot_df", "a_stats", "a_dedup", "a_flatten_distinct", "w_tumbling", "o_sort", "o_topk", "x_dedup_subset", "s_clean", "f_rlike",
    "arr_access", "js_path", "udf_sql", "udf_pandas", "src_csv_typed", "src_json_nested", "ld_envelope_json", "ld_latest_per_table",
    "ld_write_modes", "tb_append", "tb_update", "tb_delete", "tb_merge", "tb_compact", "tb_copy_into", "q_multi", "st_ingest",
    "st_agg", "st_scd1", "st_stream_join",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark, queries = local_session(cpus), all_queries()
    names = [n for n in queries if any(n.startswith(p) for p in only)] if only else list(HEADLINE)
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")), "cpus": cpus, "runs": runs,
    }))


if __name__ == "__main__":
    main()
