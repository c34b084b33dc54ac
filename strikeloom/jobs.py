"""The jobs users run: load quote files, run strategies, check what they stored."""

import logging
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import partial

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from strikeloom.operators.enrich import enrich
from strikeloom.operators.lookback import lookback, newest_stored_date
from strikeloom.operators.policies import named
from strikeloom.operators.reports import head, layer_counts
from strikeloom.plans.registry import ACTIVE, STRATEGIES, Strategy
from strikeloom.schema import UNDERLYINGS
from strikeloom.sinks import statistics
from strikeloom.sinks.bars import absorb_bars
from strikeloom.sinks.catalog import create_database
from strikeloom.sinks.layers import gold_table, rejects_table, replace_gold, rules_of, silver_table
from strikeloom.sources.bars import normalise_bars, read_bar_replies
from strikeloom.sources.files import READERS
from strikeloom.streaming.intake import absorb, complete_loads, replace_all

logger = logging.getLogger(__name__)


def load(
    spark: SparkSession,
    path: str | list[str],
    database: str,
    bootstrap: bool = False,
    raw_format: str = "csv",
    policies: Iterable[str] = (),
    underlyings: Mapping[str, str] = UNDERLYINGS,
    regroup: bool = False,
    new_versions: bool = False,
    allow_empty: bool = False,
) -> int:
    """Quote files to bronze and silver; returns how many lines could not be read.

    Such lines, cut short or with a field of another type, are kept with their file in the rejects
    table and stay out of both layers.

    ``bootstrap`` makes the files the whole content of both tables; with no files at all that would
    wipe them, so it is refused unless ``allow_empty`` is set. Otherwise files are added, or
    replace what was loaded from the same path, and only these files are enriched again; naming
    files that were loaded before reprocesses them. A file of the same name from another
    folder is a file of its own, unless ``new_versions`` says that it replaces the others.
    Policies and mapping are kept with silver; loads with other ones are refused until a bootstrap.
    A load that breaks off is on record, and the next one completes it. Loads of one database run
    one after another.
    Set ``regroup`` for many small files.
    """
    policies = tuple(policies)
    create_database(spark, database)
    enrichment = partial(enrich, underlyings=underlyings, policies=named(policies))
    rules = rules_of(policies, underlyings)
    quotes = READERS[raw_format](spark, path)
    if bootstrap:
        if not allow_empty and not quotes.inputFiles():
            raise ValueError(f"no files in {path}: a bootstrap would empty database {database}")
        rejected = replace_all(quotes, database, enrichment, rules, regroup)
    else:
        rejected = absorb(quotes, database, enrichment, rules, regroup, new_versions)
    if rejected:
        logger.warning("%d lines could not be read: see %s", rejected, rejects_table(database))
    return rejected


def repair(
    spark: SparkSession,
    database: str,
    policies: Iterable[str] = (),
    underlyings: Mapping[str, str] = UNDERLYINGS,
    regroup: bool = False,
) -> int:
    """Complete loads that broke off between the layers, as the next load would; how many there were."""
    policies = tuple(policies)
    enrichment = partial(enrich, underlyings=underlyings, policies=named(policies))
    return complete_loads(spark, database, enrichment, rules_of(policies, underlyings), regroup)


def verify(spark: SparkSession, database: str) -> bool:
    """Whether the layers hold what was loaded; what differs is shown.

    The first call only counts both layers and keeps that; loads keep it up to date from then on.
    """
    if not statistics.are_kept(spark, database):
        statistics.keep(spark, database)
    found = [statistics.unreconciled(spark, database), statistics.changed_since(spark, database)]
    differing = [each for each in found if not each.isEmpty()]
    for each in differing:
        each.show(truncate=False)
    return not differing


def load_bars(spark: SparkSession, path: str, database: str) -> None:
    """Landed replies of the bars service into the database's table of daily bars."""
    create_database(spark, database)
    absorb_bars(normalise_bars(read_bar_replies(spark, path)), database)


def run_strategy(
    spark: SparkSession,
    database: str,
    name: str,
    strategy: Strategy,
    anchor: date,
    silver: DataFrame | None = None,
) -> None:
    silver = spark.table(silver_table(database)) if silver is None else silver
    window = lookback(silver, strategy.lookback_days, anchor)
    signals = strategy.signals(window.select(*strategy.columns))
    if strategy.regroup:
        signals = signals.hint("rebalance", "trade_date")
    replace_gold(signals, gold_table(database, name))


def shared_silver(
    spark: SparkSession, database: str, strategies: Iterable[Strategy], anchor: date
) -> DataFrame:
    """What any of the strategies reads of silver: the widest lookback and all columns they name.

    Kept by the executors in memory or on their disks. Tasks that ask for a part which another one
    is reading wait for it, so strategies that run side by side scan silver once; what a lost
    executor held is read again.
    """
    strategies = list(strategies)
    columns = dict.fromkeys(column for each in strategies for column in ("trade_date", *each.columns))
    days = max(each.lookback_days for each in strategies)
    window = lookback(spark.table(silver_table(database)), days, anchor)
    return window.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)


def strategy_tag(database: str, name: str) -> str:
    """The tag that all Spark jobs of one strategy's run carry."""
    return f"strikeloom-{database}-{name}"


def cancel_strategy(spark: SparkSession, database: str, name: str) -> None:
    """Stop the jobs of one running strategy; it counts as failed and leaves the others alone."""
    spark.sparkContext.cancelJobsWithTag(strategy_tag(database, name))


def run_strategies(
    spark: SparkSession,
    database: str,
    names: Iterable[str] | None = None,
    registry: Mapping[str, Strategy] = STRATEGIES,
    shared_scan: bool = False,
) -> dict[str, bool]:
    """Run strategies side by side and tell for each whether it succeeded.

    ``names`` may list any registered strategy; without it the active ones run. Each is submitted
    from its own thread in its own scheduler pool with its own job tag, so one that fails or is
    cancelled leaves the others alone. With no dated silver rows there is nothing to do, which
    counts as success and stores nothing.

    ``shared_scan`` reads silver once for all of them and keeps that in the executors until they
    are done: worth it where storage is slow or far and strategies overlap in what they read.
    Otherwise each one scans its own columns and dates.
    """
    names = list(dict.fromkeys(ACTIVE if names is None else names))
    anchor = newest_stored_date(spark, silver_table(database))
    known = [registry[name] for name in names if name in registry]
    shared = None
    if shared_scan and anchor is not None and len(known) > 1:
        shared = shared_silver(spark, database, known, anchor)

    def attempt(name: str) -> bool:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        spark.sparkContext.addJobTag(strategy_tag(database, name))
        try:
            strategy = registry[name]
            if anchor is None:
                logger.warning("%s: silver has no dated rows, nothing to do", name)
            else:
                run_strategy(spark, database, name, strategy, anchor, shared)
            return True
        except Exception:
            logger.exception("strategy %s failed", name)
            return False

    try:
        with ThreadPoolExecutor(max(1, len(names))) as threads:
            runs = [threads.submit(inheritable_thread_target(spark)(attempt), name) for name in names]
            return {name: run.result() for name, run in zip(names, runs)}
    finally:
        if shared is not None:
            shared.unpersist()


def has_gold(spark: SparkSession, database: str, name: str) -> bool:
    return spark.catalog.tableExists(gold_table(database, name))


def gold_counts(spark: SparkSession, database: str, names: Iterable[str]) -> DataFrame:
    """Row count of each strategy's gold table."""
    return layer_counts({name: spark.table(gold_table(database, name)) for name in names})


def gold_sample(spark: SparkSession, database: str, name: str, n: int = 10) -> DataFrame:
    gold = spark.table(gold_table(database, name))
    return head(gold, ["trade_date", *[c for c in gold.columns if c != "trade_date"]], n)
