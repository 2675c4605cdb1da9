"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The report inputs are derived from the test tables once (``derive_sec``) and
stored in the warehouse layout in the checkpoint folder, as the reports read
stored warehouse tables; each query is then timed end to end (plan build,
bounds, execution, collect; nothing is cached between runs), best of ``BENCH_REPEAT`` warm runs, plus the
first (cold) run of the flagship report.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "report_new",        # the promo report (flagship)
    "report_legacy",     # the legacy promo report
    "condition_sales",   # qualifying sales, row level
    "recon_by_tin",      # sold vs declared by buyer TIN
    "recon_grouped",     # sold vs declared per promo
    "hot_by_tin",        # presentation of recon_by_tin
    "hot_grouped",       # presentation of recon_grouped
]


def _sf_number(sf_dir: str):
    name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    from packlift import registry
    from packlift.session import get_spark
    from packlift.sources.tpch import load_tpch

    spark = get_spark(f"local[{cpus}]", app="packlift-bench", shuffle_partitions=max(cpus, 2),
                      extra={"spark.driver.memory": "16g"})
    t0 = time.time()
    load_tpch(spark, sf_dir)
    derive_sec = time.time() - t0

    qs = registry.queries()
    times, medians, rows = {}, {}, {}
    t0 = time.time()
    rows["report_new"] = len(qs["report_new"](spark, sf_dir).collect())
    cold = time.time() - t0
    for name in HEADLINE:
        runs = []
        for _ in range(repeat):
            t0 = time.time()
            rows[name] = len(qs[name](spark, sf_dir).collect())
            runs.append(time.time() - t0)
        times[name] = round(min(runs), 3)
        medians[name] = round(statistics.median(runs), 3)
    sale_rows = load_tpch(spark, sf_dir).sale.count()
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "queries_median": medians,
        "sf": _sf_number(sf_dir),
        "report_new_cold_sec": round(cold, 3),
        "derive_inputs_sec": round(derive_sec, 3),
        "rows": rows,
        "sale_rows": sale_rows,
        "report_new_sale_rows_per_sec": round(sale_rows / times["report_new"]) if times["report_new"] else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
