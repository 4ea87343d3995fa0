"""Time the headline queries and print one JSON line.

Every query runs on a fresh lakehouse, from the raw tables through all the layers it needs,
including the tables it stores on the way. The figure is the median of warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from shopscope.catalog import CATALOG
from shopscope.plans.lakehouse import Lakehouse
from shopscope.session import build_session

HEADLINE = (
    "profile_order_items",
    "doc_dq_scorecard",
    "silver_geolocation",
    "gold_order_summary",
    "gold_customer_360",
    "gold_customer_category_behavior",
    "gold_customer_experience",
    "gold_customer_intelligence",
    "gold_executive_kpis",
    "view_customer_segments",
)
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        with Lakehouse.over_testdata(spark, directory) as lake:
            start = time.perf_counter()
            CATALOG[name](lake).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": directory.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
