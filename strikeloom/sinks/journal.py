"""What every load is about to change and how far it came.

A load has one partition per state it is in, with the files it takes in. It moves on by a rename of
that partition, so a state costs no job, and a look at the catalog tells which loads broke off.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strikeloom.schema import JOURNAL, SOURCE
from strikeloom.sinks.catalog import drop_partitions, partition_keys, sql_literal

KEY = ("load_id", "state")
# The states of a load, in turn.
LANDED, BRONZE_DONE, SILVER_DONE = "landed", "bronze", "silver"
# Finished loads that stay on record.
KEPT = 200
ROWS_PER_STATEMENT = 2000

# Trade date as ISO text, and source: a partition of bronze.
FileKey = tuple[str | None, str | None]


def journal_table(database: str) -> str:
    return f"{database}.{JOURNAL}"


@dataclass(frozen=True)
class Load:
    """One load on record."""

    spark: SparkSession
    table: str
    load_id: str

    def partition(self, state: str) -> str:
        return f"PARTITION (load_id = {sql_literal(self.load_id)}, state = {sql_literal(state)})"

    def add(self, files: set[FileKey]) -> None:
        """Further files that the load takes in, while it is in its first state."""
        rows = sorted(files, key=str)
        for start in range(0, len(rows), ROWS_PER_STATEMENT):
            values = ", ".join(
                f"(CAST({sql_literal(day)} AS DATE), {sql_literal(source)})"
                for day, source in rows[start : start + ROWS_PER_STATEMENT]
            )
            self.spark.sql(f"INSERT INTO {self.table} {self.partition(LANDED)} VALUES {values}")

    def reached(self, state: str) -> None:
        """Move the load on to its next state."""
        before = self.partition(BRONZE_DONE if state == SILVER_DONE else LANDED)
        self.spark.sql(f"ALTER TABLE {self.table} {before} RENAME TO {self.partition(state)}")

    def dismissed(self) -> None:
        """Take the load off the record, whatever state it is in."""
        states = [(self.load_id, state) for state in (LANDED, BRONZE_DONE)]
        drop_partitions(self.spark, self.table, KEY, states)


def begin(spark: SparkSession, database: str, files: set[FileKey], everything: bool = False) -> Load:
    """Put a load on record before it changes anything.

    ``everything`` says that silver will be made anew as a whole, which a row without a source
    stands for.
    """
    table = journal_table(database)
    if not spark.catalog.tableExists(table):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} (trade_date DATE, {SOURCE} STRING, load_id STRING, "
            f"state STRING) USING parquet PARTITIONED BY (load_id, state)"
        )
    load = Load(spark, table, f"{time.time_ns():020d}-{uuid4().hex[:8]}")
    if everything or files:
        load.add({(None, None)} if everything else files)
    else:
        spark.sql(f"ALTER TABLE {table} ADD {load.partition(LANDED)}")
    return load


def broken_off(spark: SparkSession, database: str) -> tuple[set[FileKey], bool, list[Load]]:
    """Files whose silver rows may be stale, whether all of silver may be, and the loads to blame.

    Only the partitions of unfinished loads are read.
    """
    table = journal_table(database)
    if not spark.catalog.tableExists(table):
        return set(), False, []
    states = partition_keys(spark, table)
    loads = [Load(spark, table, load_id) for load_id, state in states if state != SILVER_DONE]
    if not loads:
        return set(), False, []
    rows = spark.table(table).where(F.col("load_id").isin([load.load_id for load in loads]))
    keys = rows.select(F.col("trade_date").cast("string"), SOURCE).distinct().collect()
    files = {(day, source) for day, source in keys if source is not None}
    return files, any(source is None for _, source in keys), loads


def settle(spark: SparkSession, load: Load, repaired: list[Load]) -> None:
    """Close a load whose silver rows are stored, and those that it repaired on the way."""
    load.reached(SILVER_DONE)
    for each in repaired:
        each.dismissed()
    finished = sorted(key for key in partition_keys(spark, load.table) if key[1] == SILVER_DONE)
    drop_partitions(spark, load.table, KEY, finished[:-KEPT])
