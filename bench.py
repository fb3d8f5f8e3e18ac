"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set), BENCH_ALL=1 to time
every registered query. Each query is executed to completion with the
``noop`` sink (full plan, no driver collect), once cold and once warm;
the reported time is the warm run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "payroll_by_task", "payroll_employee_comparison", "weekly_schedule", "staffing_per_period", "inventory_summary",
    "spray_restrictions", "light_dose", "pack_day_summary", "invoice_summary", "latest_snapshot", "keep_first",
    "range_join", "asof_next", "group_sum", "alloc_proportional", "payroll_task_comparison", "payroll_secure", "palletize",
    "lock_preserving_refresh", "price_resolution",
)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    os.environ.setdefault("FURROW_MASTER", f"local[{cpus}]")
    os.environ.setdefault("FURROW_SHUFFLE_PARTITIONS", str(max(cpus, 8)))
    from furrow.plans import catalog
    from furrow.session import build_session

    spark = build_session()
    qs = catalog.queries()
    names = list(qs) if os.environ.get("BENCH_ALL") else [
        n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n in qs]
    times, cold = {}, {}
    for n in names:
        t0 = time.time()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        cold[n] = round(time.time() - t0, 3)
        t0 = time.time()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_warm_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "cold": cold, "sf": sf, "cpus": cpus,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"), "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
