"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed completely (``noop`` sink: the whole plan runs, no
rows are collected to the driver); the time is the best of ``BENCH_RUNS``
runs (plan building included) after one untimed warm-up run of that query
(JVM class loading and code generation). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerwatch.plans import catalog  # noqa: E402
from ledgerwatch.session import get_session  # noqa: E402

HEADLINE = [
    "fraud_report",               # all four rules, all days, card = user_id
    "fraud_report_rules34",       # all four rules, card = user_id % 10 (rules 3/4 fire widely)
    "fraud_report_day",           # one report day with the look-back across midnight
    "rule3_flagged",              # rule 3 flag pass only (baseline probe: window 1.6 s, self-join 13.1 s)
    "rule4_flagged",              # rule 4 flag pass only, 7200 s (baseline probe: window 1.3 s, self-join 46.8 s)
    "rule3_city_hop",             # 1 h city hop, report rows
    "rule4_amount_guess",         # 7200 s amount guessing
    "rule4_amount_guess_native",  # 1200 s, one card for all rows (hot key)
    "candidates",
    "valid_at_terminals",
    "scd2_three_batches",
    "scd2_clients",
    "append_absent_tx",
    "delta_filter",
    "load_gate",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_session(f"local[{cpus}]", max(8, 2 * cpus), app_name="ledgerwatch-bench",
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:] or HEADLINE
    times = {}
    for name in only:
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        best = None
        for _ in range(runs):
            t0 = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus}))


if __name__ == "__main__":
    main()
