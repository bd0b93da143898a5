"""Benchmark: seconds per query at $BENCH_SF_DIR, as one JSON line.

``warehouse_build`` is the whole pipeline from the given tables to all stored tables
in a fresh folder. The other entries run warm over the stored inputs of the query,
every row and column of the result computed; the median of $BENCH_REPEATS runs counts.
$BENCH_QUERIES names other queries than the headline ones, or ``all``.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tallyhouse.plans.registry import QUERIES, warehouse
from tallyhouse.plans.warehouse import MODELS, Warehouse
from tallyhouse.session import local_session, scratch_path
from tallyhouse.sources import star

HEADLINE = [
    "raw_dedup",
    *MODELS,
    "fct_invoice_lines_incremental",
    "fct_invoice_lines_lookback",
    "kpi_headline",
    "cohort_matrix",
    "rfm_segment_rollup",
    "region_rollup",
    "top_products",
    "revenue_concentration",
    "dq_stg_online_retail",
    "dq_fct_invoice_lines",
    "dq_order_revenue_reconciles",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def build(spark, folder: str) -> None:
    Warehouse(
        spark,
        scratch_path(spark, "bench"),
        raw=star.shop_scan(spark, folder),
        country_region=star.shop_regions(spark, folder),
        loaded_at=star.LOADED_AT,
    ).build()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE

    spark = local_session(cores)
    warehouse(spark, folder).build()
    timed = {}
    for name in names:
        query = QUERIES[name]
        run(query(spark, folder))
        timed[name] = statistics.median(
            seconds(lambda: run(query(spark, folder))) for _ in range(repeats)
        )
    timed["warehouse_build"] = seconds(lambda: build(spark, folder))
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in timed.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": cores,
                "repeats": repeats,
            }
        )
    )


if __name__ == "__main__":
    main()
