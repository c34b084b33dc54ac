"""File intake in micro-batches: landing folder to bronze and silver."""

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from strikeloom.operators.enrich import enrich
from strikeloom.operators.policies import named
from strikeloom.schema import UNDERLYINGS
from strikeloom.sinks import journal, statistics
from strikeloom.sinks.catalog import create_database
from strikeloom.sinks.journal import FileKey
from strikeloom.sinks.layers import (
    Enrichment,
    bronze_table,
    file_key,
    keep_rules,
    rebuild_silver,
    refresh_silver,
    rejects_table,
    replace_bronze,
    replace_bronze_files,
    require_same_rules,
    rules_of,
    silver_table,
    versions_of,
)
from strikeloom.sources.files import stream_quote_csv

# Fixed value: files taken per micro-batch.
FILES_PER_BATCH = 15


def absorb(
    quotes: DataFrame,
    database: str,
    enrichment: Enrichment,
    rules: Mapping[str, str],
    regroup: bool = False,
    new_versions: bool = False,
) -> int:
    """Take quote files into bronze and refresh their rows in silver; safe to repeat.

    The load is put on record before it changes anything. Files that an earlier load left between
    the layers are brought up to date along with the new ones, whatever files those are. Returns
    the number of lines that could not be read and went to the rejects table.
    """
    spark = quotes.sparkSession
    bronze, silver = bronze_table(database), silver_table(database)
    stale, all_stale, broken = journal.broken_off(spark, database)
    if not all_stale:
        require_same_rules(spark, silver, rules)
    landed = set(map(file_key, quotes.inputFiles()))
    if new_versions:
        landed |= versions_of(spark, bronze, landed)
    load = journal.begin(spark, database, landed, everything=all_stale)
    changed, rejected = replace_bronze_files(quotes, bronze, rejects_table(database), new_versions)
    if not changed <= landed and not all_stale:
        load.add(changed - landed)
    load.reached(journal.BRONZE_DONE)
    if all_stale:
        rebuild_silver(spark, bronze, silver, enrichment, regroup)
    else:
        refresh_silver(spark, bronze, silver, enrichment, changed | stale, regroup)
    keep_rules(spark, silver, rules)
    _keep_statistics(spark, database, None if all_stale else changed | stale)
    journal.settle(spark, load, broken)
    return rejected


def _keep_statistics(spark: SparkSession, database: str, files: set[FileKey] | None) -> None:
    """Count ``files``, or all, anew where statistics are kept; before a load is closed on record."""
    if statistics.are_kept(spark, database):
        if files is None:
            statistics.keep(spark, database)
        else:
            statistics.refresh(spark, database, files)


def replace_all(
    quotes: DataFrame,
    database: str,
    enrichment: Enrichment,
    rules: Mapping[str, str],
    regroup: bool = False,
) -> int:
    """Make quote files the whole content of bronze and silver; the number of unreadable lines."""
    spark = quotes.sparkSession
    bronze, silver = bronze_table(database), silver_table(database)
    _, _, broken = journal.broken_off(spark, database)
    load = journal.begin(spark, database, set(), everything=True)
    rejected = replace_bronze(quotes, bronze, rejects_table(database))
    load.reached(journal.BRONZE_DONE)
    rebuild_silver(spark, bronze, silver, enrichment, regroup)
    keep_rules(spark, silver, rules)
    _keep_statistics(spark, database, None)
    journal.settle(spark, load, broken)
    return rejected


def complete_loads(
    spark: SparkSession,
    database: str,
    enrichment: Enrichment,
    rules: Mapping[str, str],
    regroup: bool = False,
) -> int:
    """Bring silver up to date where loads broke off between the layers; how many there were.

    Every load does the same for itself. No other load may be running.
    """
    stale, all_stale, broken = journal.broken_off(spark, database)
    if not broken:
        return 0
    bronze, silver = bronze_table(database), silver_table(database)
    if spark.catalog.tableExists(bronze):
        if all_stale:
            rebuild_silver(spark, bronze, silver, enrichment, regroup)
        else:
            require_same_rules(spark, silver, rules)
            refresh_silver(spark, bronze, silver, enrichment, stale, regroup)
        keep_rules(spark, silver, rules)
        _keep_statistics(spark, database, None if all_stale else stale)
    for load in broken:
        load.dismissed()
    return len(broken)


def run_intake(
    spark: SparkSession,
    landing: str,
    database: str,
    checkpoint: str,
    files_per_batch: int = FILES_PER_BATCH,
    archive: str | None = None,
    policies: tuple[str, ...] = (),
    underlyings: Mapping[str, str] = UNDERLYINGS,
    regroup: bool = False,
) -> None:
    """Process every file that landed since the last call, then stop.

    The checkpoint records what was processed. A batch that failed half-way is run again as a whole,
    which changes nothing that was already stored. ``archive`` must lie outside ``landing``.
    """
    create_database(spark, database)
    enrichment = partial(enrich, underlyings=underlyings, policies=named(policies))
    rules = rules_of(policies, underlyings)
    query = (
        stream_quote_csv(spark, landing, files_per_batch, archive)
        .writeStream.foreachBatch(
            lambda quotes, _: absorb(quotes, database, enrichment, rules, regroup)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Batches are written in a session of the stream; this one may hold older file listings.
    tables = (bronze_table, silver_table, rejects_table)
    for table in (name(database) for name in tables):
        if spark.catalog.tableExists(table):
            spark.catalog.refreshTable(table)
