"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores and BENCH_QUERIES
(optional, comma-separated) other queries. Every query is run once on small data
to load classes, then timed once from building the plan to the last row. The
stored demand that the evaluation reads is timed on its own as store_demand, and
the stored line state that daily runs read as store_line_state.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from validation.adapter import evaluation_tables, line_state  # noqa: E402
from validation.compare import local_session  # noqa: E402
from validation.spark_queries import QUERIES  # noqa: E402

HEADLINE = (
    "zone_join",
    "order_lines_all",
    "line_stats",
    "stockouts_by_wh",
    "demand_exp1",
    "demand_exp2",
    "demand_exp8",
    "demand_all_variants",
    "demand_day_variants",
    "full_load_daily",
    "cohort",
    "gmv_share",
    "forecast_wide",
    "mafe_product",
    "mafe_warehouse",
    "mafe_category",
    "design_matrix",
)


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cores, int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    small = Path(sf_dir).parent / "sf0.001"
    for name in names:
        run(spark, name, str(small) if small.exists() else sf_dir)
    started = time.perf_counter()
    evaluation_tables(spark, sf_dir)
    seconds = {"store_demand": round(time.perf_counter() - started, 3)}
    started = time.perf_counter()
    line_state(spark, sf_dir)
    seconds["store_line_state"] = round(time.perf_counter() - started, 3)
    seconds.update({name: round(run(spark, name, sf_dir), 3) for name in names})
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
