"""Headline timings: one full build of the marts, then queries over them.

Reads BENCH_SF_DIR and BENCH_CPUS; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from sampleset.queries import QUERIES, workspace

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINES = (
    "silver_issue silver_issue_field_history silver_sprint_issue silver_epic_issue "
    "fct_issue fct_issue_transitions fct_sprint_velocity fct_worklog "
    "dim_user dim_project agg_project_health agg_team_productivity agg_time_in_status "
    "created_resolved_daily metric_issue_by_project metric_worklog_by_author "
    "metric_issue_rows ds_project_health ds_velocity_recent ds_issue_medians "
    "kpi_portfolio kpi_flow q_p90_in_review q_top_hours"
).split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("flowlens-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 4)


def main() -> None:
    spark = session()
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {"build_all_marts": timed(workspace(spark, FOLDER).pipeline.build)}
    for name in HEADLINES:
        runs = [timed(lambda: consume(QUERIES[name](spark, FOLDER))) for _ in range(RUNS)]
        seconds[name] = round(statistics.median(runs), 4)
    print(
        json.dumps(
            {
                "metric": "seconds for one mart build plus the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
