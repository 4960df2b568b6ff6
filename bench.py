"""Times the headline queries: prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the cores. Each query runs once to
warm up and is then timed three times (once if that run takes over ``LONG_S``),
reading its whole result into a sink that keeps nothing; the median counts.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

import showcase
from ledgerloom.session import build

LONG_S, MEMORY = 10, "16g"
HEADLINE = [
    # whole plans
    "silver_blocks", "silver_receipts", "silver_transactions", "silver_logs", "silver_traces", "gold_traces",
    "backlog_realtime_blocks", "sales_joepegs", "sales_element", "sales_salvor", "sales_seaport_1_6", "sales_complete",
    # operators that shuffle or keep state
    "win_latest_per_key", "win_top1_flag", "win_ordinal", "win_running_sum", "win_fill_both_ways",
    "join_asof_next", "join_either_key", "join_hourly_price", "join_ancestor_prefix", "join_operator_transfer",
    "agg_sum_multi", "agg_object", "set_union_distinct", "set_except",
    "sink_delete_insert", "sink_merge_partial", "dq_sequence_gaps", "dq_unique_combination",
    # row-by-row work
    "fn_hex_to_int", "fn_abi_dynamic_array", "fn_surrogate_key", "proj_json_paths",
]


def run(fn, spark, folder: str) -> float:
    start = time.perf_counter()
    fn(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": MEMORY,
        "spark.sql.shuffle.partitions": cpus, "spark.python.sql.dataFrameDebugging.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = showcase.queries()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        run(queries[name], spark, folder)
        runs = [run(queries[name], spark, folder)]
        while len(runs) < 3 and runs[0] < LONG_S:
            runs.append(run(queries[name], spark, folder))
        times[name] = round(statistics.median(runs), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "cores": int(cpus), "memory": MEMORY, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
