"""Sketched profiles of silver, one row per trade date, kept as a table and refreshed by date."""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strikeloom.operators.profiles import merged, sketched
from strikeloom.sinks.catalog import drop_partitions, partition_keys
from strikeloom.sinks.layers import BY_DATE, on_partition, silver_table
from strikeloom.sinks.partitioned import replace_partitions, replace_table

# Columns profiled: numbers by quantiles, items by distinct values and frequent ones.
NUMBERS = ("bid_px_00", "ask_px_00", "mid_price", "strike_price", "price")
ITEMS = ("symbol", "underlying", "option_type")


def profile_table(database: str) -> str:
    return f"{database}.silver_profile"


def keep_profile(spark: SparkSession, database: str, dates: Iterable[str | None] | None = None) -> None:
    """Profile silver: all dates, or anew those of ``dates`` (ISO texts), reading only their partitions.

    A date that silver no longer has loses its row.
    """
    table, stored = profile_table(database), spark.table(silver_table(database))
    if dates is None:
        replace_table(_rows(stored), table, BY_DATE)
        return
    wanted = set(dates)
    if wanted:
        written = replace_partitions(_rows(stored.where(on_partition("trade_date", wanted))), table, BY_DATE)
        held = set(partition_keys(spark, table, "trade_date", wanted))
        drop_partitions(spark, table, BY_DATE, held - written)


def _rows(silver: DataFrame) -> DataFrame:
    return sketched(silver, NUMBERS, ITEMS, "trade_date")


def profile(
    spark: SparkSession,
    database: str,
    first: str | None = None,
    last: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """The kept profile of the dates from ``first`` to ``last``, merged; silver is not read."""
    rows = spark.table(profile_table(database))
    if first is not None:
        rows = rows.where(F.col("trade_date") >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.where(F.col("trade_date") <= F.lit(last).cast("date"))
    return merged(rows, NUMBERS, ITEMS, *by)
