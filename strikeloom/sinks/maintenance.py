"""Upkeep of stored tables: slices and file sizes."""

from collections.abc import Mapping
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strikeloom.sinks.catalog import (
    NULL_PARTITION,
    drop_partitions,
    partition_keys,
    replace_written_partitions_only,
    set_table_properties,
    table_properties,
)
from strikeloom.sinks.dealing import STREAMED_TASKS

# Fixed value: size data files should have.
TARGET_FILE_BYTES = 512 * 1024 * 1024
# Rows of a file that one task sorts: half a gigabyte to a gigabyte of quotes, which it need not spill.
ROWS_PER_FILE = 2_000_000
# Sorted anew, the same rows may take a little less room: not worth another rewrite.
TOLERANCE = 1.1
# Property of a copy that holds all rows it was made for.
COMPLETE = "strikeloom.complete"


def materialize_slice(spark: SparkSession, source: str, target: str, criteria: str) -> None:
    """Store the rows of ``source`` that meet a SQL predicate as table ``target``."""
    if source.lower() == target.lower():
        raise ValueError("a slice cannot replace the table it is read from")
    rows = spark.table(source).where(criteria)
    rows.write.mode("overwrite").format("parquet").saveAsTable(target)


def file_sizes(spark: SparkSession, table: str, column: str) -> DataFrame:
    """Files and bytes per partition value, from file metadata alone: contents are not read."""
    described = spark.sql(f"DESCRIBE FORMATTED {table}")
    location = described.where("col_name = 'Location'").first()["data_type"]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(location)
    return files.groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def _bloated(
    spark: SparkSession, table: str, column: str, target_bytes: int
) -> dict[str | None, int]:
    """Files wanted by each partition that holds more than its bytes, or rows to sort, call for."""
    sizes = file_sizes(spark, table, column)
    many = sizes.where(F.col("files") > F.ceil(F.col("bytes") * TOLERANCE / target_bytes)).collect()
    if not many:
        return {}
    # No column is read for that.
    counted = spark.table(table).groupBy(F.col(column).cast("string")).count().collect()
    numbers = {value: number for value, number in counted}
    most = max(ROWS_PER_FILE, ceil(sum(numbers.values()) / STREAMED_TASKS))
    wanted = {
        value: max(ceil(size / target_bytes), ceil(numbers.get(value, 0) / most)) for value, _, size in many
    }
    return {value: wanted[value] for value, files, _ in many if files > wanted[value]}


def _key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(NULL_PARTITION))


def _partitions(rows: DataFrame, column: str, values: list[str | None]) -> DataFrame:
    return rows.where(_key(column).isin([value or NULL_PARTITION for value in values]))


def _grouped(
    rows: DataFrame,
    column: str,
    order: tuple[str, ...],
    wanted: dict[str | None, int],
    further: tuple[str, ...] = (),
) -> DataFrame:
    """One task, hence one file, per wanted file. Rows are dealt out in turn.

    The plan of tasks has a row per partition of the table, no more than the catalog lists.
    """
    spark = rows.sparkSession
    first, plan = 0, []
    for value, files in wanted.items():
        plan.append((value or NULL_PARTITION, first, files))
        first += files
    # Without the hint all rows are shuffled and sorted for the join before they are dealt out.
    tasks = F.broadcast(spark.createDataFrame(plan, "_value string, _first int, _files int"))
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    placed = numbered.join(tasks, _key(column) == F.col("_value")).repartitionById(
        first, F.col("_first") + F.pmod("_row", "_files").cast("int")
    )
    # A table's writer wants the rows of a task by all partition columns, or sorts them again.
    return placed.sortWithinPartitions(column, *further, *order).select(*rows.columns)


def _copy_of(table: str) -> str:
    return f"{table}__compact"


def _require_same_counts(copy: DataFrame, rows: DataFrame, column: str) -> None:
    def counts(frame: DataFrame, name: str) -> DataFrame:
        return frame.groupBy(_key(column).alias("_value")).agg(F.count(F.lit(1)).alias(name))

    both = counts(copy, "_copied").join(counts(rows, "_stored"), "_value", "full")
    if not both.where(~F.col("_copied").eqNullSafe(F.col("_stored"))).isEmpty():
        raise RuntimeError("the table changed while it was compacted; nothing was replaced")


def _take_over(
    spark: SparkSession, table: str, column: str, order: tuple[str, ...], wanted: dict
) -> None:
    columns = tuple(c.name for c in spark.catalog.listColumns(table) if c.isPartition)
    copied = _grouped(spark.table(_copy_of(table)), column, order, wanted, columns[1:])
    replace_written_partitions_only(spark, table)
    if columns != (column,):
        # The copy may hold the rows in other parts of their values.
        drop_partitions(spark, table, columns, partition_keys(spark, table, column, wanted))
    copied.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    spark.sql(f"DROP TABLE {_copy_of(table)}")


def finish_compaction(
    spark: SparkSession, table: str, column: str, order: tuple[str, ...] = ()
) -> list[str | None]:
    """Put the complete copy that a broken-off compaction left in place; returns its values.

    It replaces what these partitions hold, so call it before anything else is loaded into them.
    """
    files = {value: n for value, n, _ in file_sizes(spark, _copy_of(table), column).collect()}
    if table_properties(spark, _copy_of(table)).get(COMPLETE) != "true":
        raise ValueError(f"{_copy_of(table)} is not a complete copy")
    _take_over(spark, table, column, order, files)
    return list(files)


def compact(
    spark: SparkSession,
    table: str,
    column: str,
    order: tuple[str, ...] = (),
    target_bytes: int = TARGET_FILE_BYTES,
    same: Mapping[str, str] | None = None,
) -> list[str | None]:
    """Rewrite partitions that hold more files than their bytes call for; returns their values.

    The rows are first written to a table beside, with as many files as the stored bytes call for,
    or more where a file would get more than ROWS_PER_FILE rows to sort (beyond STREAMED_TASKS times
    as many in the table, that share of them).
    Where rows got smaller by that, the copy is grouped again, so a second run finds nothing to do.
    Only a copy with the same row counts replaces the partitions, and it is dropped after that: at
    any moment one of the two is whole. ``column`` is the table's first partition column; ``same``
    gives the value that further ones get, so that the parts of a value become one. A complete copy left by a broken-off run is refused; see
    ``finish_compaction``. No other job may write to these partitions meanwhile.
    """
    copy = _copy_of(table)
    if spark.catalog.tableExists(copy) and table_properties(spark, copy).get(COMPLETE) == "true":
        raise ValueError(f"{copy} was left by a broken-off compaction: finish that first")
    wanted = _bloated(spark, table, column, target_bytes)
    if not wanted:
        return []
    rows = _partitions(spark.table(table), column, list(wanted))
    rows = rows.withColumns({name: F.lit(value) for name, value in (same or {}).items()})
    more = wanted
    while more:
        _grouped(rows, column, order, wanted).write.mode("overwrite").partitionBy(
            column
        ).saveAsTable(copy)
        more = _bloated(spark, copy, column, target_bytes)
        wanted = wanted | more
    _require_same_counts(spark.table(copy), rows, column)
    set_table_properties(spark, copy, {COMPLETE: "true"})
    _take_over(spark, table, column, order, wanted)
    return list(wanted)
