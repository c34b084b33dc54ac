"""Command line: ``python -m strikeloom --mode dataload|bars|strategy|stream|compact|repair|verify ...``."""

import argparse
import json
import logging
import sys

from pyspark.sql import SparkSession

from strikeloom import jobs
from strikeloom.operators.policies import POLICIES
from strikeloom.plans.registry import STRATEGIES
from strikeloom.schema import MERGED, PART, UNDERLYINGS
from strikeloom.sinks.layers import SILVER_ORDER, gold_table, silver_table
from strikeloom.sinks.maintenance import compact
from strikeloom.streaming.intake import FILES_PER_BATCH, run_intake


def parse(arguments: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="strikeloom", description=__doc__)
    modes = ["dataload", "bars", "strategy", "stream", "compact", "repair", "verify"]
    parser.add_argument("--mode", required=True, choices=modes)
    parser.add_argument("--database", default="options")
    parser.add_argument("--path", help="landed quote files (dataload, stream) or bar replies (bars)")
    parser.add_argument("--format", default="csv", choices=["csv", "parquet"])
    parser.add_argument("--bootstrap", action="store_true", help="replace all loaded data")
    parser.add_argument("--allow-empty", action="store_true", help="bootstrap without any files")
    parser.add_argument(
        "--new-versions",
        action="store_true",
        help="files replace those of the same name from other folders",
    )
    parser.add_argument("--regroup", action="store_true", help="for many small files")
    parser.add_argument("--policies", nargs="*", default=[], choices=sorted(POLICIES))
    parser.add_argument(
        "--underlyings",
        type=json.loads,
        default=UNDERLYINGS,
        help='option root to underlying, as JSON such as {"SPX": "SPY"}',
    )
    parser.add_argument(
        "--shared-scan", action="store_true", help="strategies read silver once (strategy)"
    )
    parser.add_argument("--strategies", nargs="*", help=f"any of {', '.join(STRATEGIES)}")
    parser.add_argument("--checkpoint", help="progress of the file stream")
    parser.add_argument("--files-per-batch", type=int, default=FILES_PER_BATCH)
    parser.add_argument("--archive", help="where processed files are moved (stream)")
    options = parser.parse_args(arguments)
    if options.mode in ("dataload", "bars", "stream") and not options.path:
        parser.error(f"--mode {options.mode} needs --path")
    if options.mode == "stream" and not options.checkpoint:
        parser.error("--mode stream needs --checkpoint")
    return options


def run(spark: SparkSession, options: argparse.Namespace) -> bool:
    """Run one job; False if a strategy failed or stored layers are not what was loaded."""
    if options.mode == "dataload":
        jobs.load(
            spark,
            options.path,
            options.database,
            options.bootstrap,
            options.format,
            options.policies,
            options.underlyings,
            regroup=options.regroup,
            new_versions=options.new_versions,
            allow_empty=options.allow_empty,
        )
    elif options.mode == "bars":
        jobs.load_bars(spark, options.path, options.database)
    elif options.mode == "stream":
        run_intake(
            spark,
            options.path,
            options.database,
            options.checkpoint,
            options.files_per_batch,
            options.archive,
            tuple(options.policies),
            options.underlyings,
            regroup=options.regroup,
        )
    elif options.mode == "compact":
        silver = silver_table(options.database)
        compact(spark, silver, "trade_date", SILVER_ORDER, same={PART: MERGED})
        for name in STRATEGIES:
            if jobs.has_gold(spark, options.database, name):
                compact(spark, gold_table(options.database, name), "trade_date")
    elif options.mode == "repair":
        jobs.repair(spark, options.database, options.policies, options.underlyings, options.regroup)
    elif options.mode == "verify":
        return jobs.verify(spark, options.database)
    else:
        outcome = jobs.run_strategies(
            spark, options.database, options.strategies or None, shared_scan=options.shared_scan
        )
        for name, succeeded in outcome.items():
            if succeeded and jobs.has_gold(spark, options.database, name):
                jobs.gold_counts(spark, options.database, [name]).show()
                jobs.gold_sample(spark, options.database, name).show(truncate=False)
        return all(outcome.values())
    return True


def main() -> None:
    logging.basicConfig(level=logging.INFO)
    options = parse(sys.argv[1:])
    session = SparkSession.builder.appName(f"strikeloom {options.mode}")
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.scheduler.mode": "FAIR",
    }.items():
        session = session.config(key, value)
    spark = session.getOrCreate()
    try:
        sys.exit(0 if run(spark, options) else 1)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
