"""Writes to partitioned tables."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strikeloom.sinks.catalog import (
    NULL_PARTITION,
    OVERWRITE_OPTION,
    drop_partitions,
    partition_keys,
    replace_written_partitions_only,
)

Keys = set[tuple[str | None, ...]]
# Stands between the values of a partition's key where they are one text; in no file name.
BETWEEN = "\x1f"


def _laid_out(frame: DataFrame, columns: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """Sort within each task and put the partition columns last, as tables have them.

    A partitioned write sorts each task's rows by the partition columns in any case; sorting by
    ``order`` as well costs little and makes files smaller and quicker to aggregate and filter.
    """
    kept = [name for name in frame.columns if name not in columns]
    return frame.sortWithinPartitions(*columns, *order).select(*kept, *columns)


def _create(frame: DataFrame, table: str, columns: tuple[str, ...]) -> None:
    writer = frame.write.mode("overwrite").format("parquet").option(*OVERWRITE_OPTION)
    writer.partitionBy(*columns).saveAsTable(table)


def _types(frame: DataFrame) -> dict[str, str]:
    return {field.name.lower(): field.dataType.simpleString() for field in frame.schema}


def _by_name(frame: DataFrame, table: str) -> DataFrame:
    """The columns of ``frame`` in the order of the table; refused if they are not the same ones."""
    stored = frame.sparkSession.table(table)
    have, want = _types(frame), _types(stored)
    faults = [f"missing {name}" for name in want if name not in have]
    faults += [f"unknown {name}" for name in have if name not in want]
    faults += [
        f"{name} is {have[name]} instead of {want[name]}"
        for name in want
        if name in have and have[name] != want[name]
    ]
    if faults:
        raise ValueError(f"columns do not fit table {table}: {', '.join(faults)}")
    return frame.select(*stored.columns)


def _written(columns: tuple[str, ...]) -> Column:
    """Metric that tells which partitions a write met: one text per distinct key."""
    texts = [F.coalesce(F.col(name).cast("string"), F.lit(NULL_PARTITION)) for name in columns]
    return F.collect_set(F.concat_ws(BETWEEN, *texts)).alias("written")


def _values(key: str) -> tuple[str | None, ...]:
    return tuple(None if text == NULL_PARTITION else text for text in key.split(BETWEEN))


def replace_partitions(
    frame: DataFrame, table: str, columns: tuple[str, ...], order: tuple[str, ...] = ()
) -> Keys:
    """Write ``frame``, replacing whole partitions; returns the keys of the partitions written.

    Columns go to those of the same name; missing, unknown or differently typed ones raise a
    ValueError before anything is written. Replaying the same input leaves the table unchanged.
    New files are staged and moved when the job commits, so lost executors only cost retries and a
    failed job leaves the old partitions as they were. The keys are observed during the write
    itself: no second pass.
    """
    spark = frame.sparkSession
    observation = Observation()
    rows = frame.observe(observation, _written(columns))
    if spark.catalog.tableExists(table):
        rows = _by_name(_laid_out(rows, columns, order), table)
        replace_written_partitions_only(spark, table)
        rows.write.mode("overwrite").insertInto(table)
    else:
        _create(_laid_out(rows, columns, order), table, columns)
    return {_values(key) for key in observation.get["written"]}


def _recreate(
    frame: DataFrame, table: str, columns: tuple[str, ...], order: tuple[str, ...]
) -> None:
    """Give the table a new layout. The rows are complete in a second table before the old one goes,
    and stay there until the new one is complete."""
    spark = frame.sparkSession
    beside = f"{table}__new"
    _create(_laid_out(frame, columns, order), beside, columns)
    _create(_laid_out(spark.table(beside), columns, order), table, columns)
    spark.sql(f"DROP TABLE {beside}")


def replace_table(
    frame: DataFrame, table: str, columns: tuple[str, ...], order: tuple[str, ...] = ()
) -> None:
    """Make ``frame`` the whole content of the table.

    With an unchanged layout, old partitions stay readable until the new ones are committed, and
    those without new rows are dropped after that. A changed layout recreates the table.
    """
    spark = frame.sparkSession
    if not spark.catalog.tableExists(table):
        _create(_laid_out(frame, columns, order), table, columns)
        return
    stored = spark.table(table)
    partitioned_by = tuple(c.name for c in spark.catalog.listColumns(table) if c.isPartition)
    if _types(frame) != _types(stored) or partitioned_by != columns:
        _recreate(frame, table, columns, order)
        return
    written = replace_partitions(frame, table, columns, order)
    stale = [key for key in partition_keys(spark, table) if key not in written]
    drop_partitions(spark, table, columns, stale)
