"""Time the headline queries and jobs; prints one JSON line.

``BENCH_SF_DIR`` names the input tables and ``BENCH_CPUS`` the cores. Each entry runs once to warm
up; the median of three further runs counts. Query results go to Spark's noop sink, so all rows are
computed and none are collected. Entries that end in ``_stored`` read the loaded tables, as the
strategy job does; the others derive quotes from ``lineitem`` first.
"""

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strikeloom import jobs
from strikeloom.checks import queries as registered
from strikeloom.checks.scratch import scratch_database
from strikeloom.operators import lookback, reports
from strikeloom.plans import condor, threshold
from strikeloom.plans.registry import STRATEGIES
from strikeloom.sinks.layers import silver_table

RUNS = 3
DERIVED = ("iron_condor", "iron_condor_all", "silver_enriched", "threshold_signals")


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strikeloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )


def scale(sf_dir: str) -> float | str:
    name = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def run_all(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def seconds(action: Callable[[], object]) -> float:
    action()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")

    landing = registered.landed(spark, sf_dir)
    files = spark.read.format("binaryFile").load(landing).selectExpr("sum(length) / 1e6 AS mb")
    landed_mb = files.first()["mb"]
    database = registered.loaded(spark, sf_dir)
    silver = spark.table(silver_table(database))
    anchor = lookback.newest_stored_date(spark, silver_table(database))
    fresh = scratch_database(spark)

    timed: dict[str, Callable[[], object]] = {
        name: lambda query=registered.QUERIES[name]: run_all(query(spark, sf_dir))
        for name in DERIVED
    }
    timed |= {
        "load_bootstrap": lambda: jobs.load(spark, landing, fresh, bootstrap=True),
        "load_one_file": lambda: jobs.load(
            spark, registered.landed_files(spark, sf_dir)[-1], database
        ),
        "strategies_job_stored": lambda: jobs.run_strategies(spark, database, list(STRATEGIES)),
        "iron_condor_all_stored": lambda: run_all(condor.iron_condors(silver)),
        "iron_condor_joins_stored": lambda: run_all(condor.iron_condors_by_joins(silver)),
        "iron_condor_stored": lambda: run_all(
            condor.iron_condors(lookback.lookback(silver, 30, anchor))
        ),
        "threshold_signals_stored": lambda: run_all(
            threshold.threshold_signals(lookback.lookback(silver, 3, anchor))
        ),
        "date_coverage_stored": lambda: run_all(reports.date_coverage(silver)),
    }
    measured = {}
    for name, action in timed.items():
        measured[name] = seconds(action)
        print(name, measured[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total time of headline queries and jobs",
                "value": round(sum(measured.values()), 3),
                "unit": "sec",
                "queries": measured,
                "sf": scale(sf_dir),
                "cpus": int(cpus),
                "load_mb_per_sec": round(landed_mb / measured["load_bootstrap"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
