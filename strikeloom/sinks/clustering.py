"""Slices laid out along a space-filling curve, so that filters on any of several columns read little.

Rows sorted by one column after another are close together in the first column only. Here the
leading bits of all columns are interleaved into one key (a Z-order curve), and rows are dealt to
files by ranges of it: each file and row group covers a small range of every column, which is what
Parquet's minima and maxima can skip by.
"""

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strikeloom.sinks.dealing import STREAMED_TASKS
from strikeloom.sinks.maintenance import TARGET_FILE_BYTES, file_sizes

DIMENSIONS = ("underlying", "expiry_date", "strike_price")
# Bits of each dimension in the key: a thousand steps between its minimum and maximum.
BITS = 10


def _position(frame: DataFrame, name: str) -> Column:
    """A value as a number whose distance means something; texts have none, so they are hashed."""
    kind = frame.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, (T.TimestampType, T.NumericType)):
        return F.col(name).cast("double")
    return F.pmod(F.xxhash64(F.col(name).cast("string")), F.lit(1 << BITS)).cast("double")


def curve_key(frame: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS) -> Column:
    """The place of a row of ``frame`` on the curve, as a long.

    Numbers, dates and instants are scaled between their minimum and maximum, which one narrow
    aggregate over ``frame`` finds; texts are hashed, which suits the equality conditions they get.
    NULL and NaN take the lowest step, so they are stored together.
    """
    if not 0 < len(dimensions) * BITS < 64:
        raise ValueError("between one and six dimensions have room in the key")
    at = {name: F.nanvl(_position(frame, name), F.lit(None).cast("double")) for name in dimensions}
    ends = frame.agg(*[end(at[name]).alias(f"{name}_{end.__name__}") for name in dimensions for end in (F.min, F.max)])
    found = ends.first().asDict()
    key = F.lit(0).cast("bigint")
    for number, name in enumerate(dimensions):
        low, high = found[f"{name}_min"], found[f"{name}_max"]
        if low is None or low == high:
            continue
        share = (at[name] - low) / (high - low) * ((1 << BITS) - 1)
        step = F.coalesce(F.floor(share).cast("bigint"), F.lit(0).cast("bigint"))
        for bit in range(BITS):
            taken = F.shiftright(step, bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(taken, bit * len(dimensions) + number))
    return key


def store_clustered(
    rows: DataFrame,
    table: str,
    files: int,
    dimensions: tuple[str, ...] = DIMENSIONS,
    within: str = "ts_recv",
    **options: str,
) -> None:
    """Store ``rows`` as ``table`` in up to ``files`` files along the curve.

    Ranges are cut by a sample of key and ``within``, so the rows of one contract, however many,
    spread over several files by time. ``options`` go to the Parquet writer. Many files are cut out
    of fewer ranges, each in the order of the curve: a shuffle to as many would hold all rows of a
    task in memory.
    """
    key = curve_key(rows, dimensions)
    tasks = max(1, files)
    if files > 2 * STREAMED_TASKS:
        tasks = STREAMED_TASKS
        options = {"maxRecordsPerFile": str(max(1, ceil(rows.count() / (files - tasks)))), **options}
    placed = rows.withColumn("_place", key).repartitionByRange(tasks, "_place", within)
    ordered = placed.sortWithinPartitions("_place", within).drop("_place")
    ordered.write.mode("overwrite").format("parquet").options(**options).saveAsTable(table)


def clustered_slice(
    spark: SparkSession,
    source: str,
    target: str,
    criteria: str,
    dimensions: tuple[str, ...] = DIMENSIONS,
    target_bytes: int = TARGET_FILE_BYTES,
) -> None:
    """Store the rows of ``source`` that meet a SQL predicate as table ``target``, along the curve.

    ``source`` is partitioned by trade date. The number of files follows from the bytes it is stored
    in, by file metadata, and the share of its rows that the slice has.
    """
    if source.lower() == target.lower():
        raise ValueError("a slice cannot replace the table it is read from")
    table = spark.table(source)
    share = table.agg(F.avg(F.when(F.expr(criteria), 1).otherwise(0))).first()[0] or 0.0
    stored = file_sizes(spark, source, "trade_date").agg(F.sum("bytes")).first()[0] or 0
    store_clustered(table.where(criteria), target, ceil(stored * share / target_bytes), dimensions)
