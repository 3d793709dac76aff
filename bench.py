"""Wall time of the headline queries; prints one JSON line.

The raw insurance tables are derived from the test tables once and written at rest; that
is the line ``raw_preparation``. Every query is then built and run from the tables at rest,
sharing nothing with the one before it. Results go to the no-op sink, so all rows and
columns are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from ratewright.plans.present import present
from ratewright.plans.queries import BUILDS, QUERY_PARAMS
from ratewright.session import build_session, scratch_path
from ratewright.sources.sample_source import resting_sample, write_sample

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "coverage_month",
    "earned_exposure_month",
    "earned_premium_month",
    "fct_exposure",
    "policy_exposure",
    "claim_financial_state_cumulative",
    "claim_valuation_snapshot",
    "claim_snapshot",
    "fct_exposure_attribute",
    "loss_triangle",
    "loss_triangle_from_snapshot",
    "loss_triangle_pooled",
    "ldf_observations",
    "claim_triangle_cumulative",
    "fct_ultimate_loss",
    "mart_indicated_rate_change_pure_premium",
    "mart_control_tolerance_by_metric",
    "relationships_report",
    "running_premium_balance",
    "change_log",
]


def prepare(spark, root: str) -> float:
    start = time.perf_counter()
    write_sample(spark, SF_DIR, root, QUERY_PARAMS, buckets=int(CPUS))
    return time.perf_counter() - start


def run(spark, name: str, root: str) -> float:
    start = time.perf_counter()
    book = resting_sample(spark, SF_DIR, root, QUERY_PARAMS)
    present(BUILDS[name](book)).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    prepare(spark, scratch_path(spark, "warm_up"))  # warm up the JVM and the file cache
    root = scratch_path(spark, "at_rest")
    times = {"raw_preparation": round(prepare(spark, root), 3)}
    run(spark, "claim_triangle_cumulative", root)
    times |= {name: round(run(spark, name, root), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
