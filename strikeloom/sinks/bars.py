"""Daily bars kept as a table by month, replaced bar by bar when a reply comes again."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strikeloom.sinks.layers import on_partition
from strikeloom.sinks.partitioned import replace_partitions
from strikeloom.sinks.shared import stored

BY_MONTH = ("month",)
ORDER = ("symbol", "timestamp")


def bars_table(database: str) -> str:
    return f"{database}.daily_bars"


def absorb_bars(bars: DataFrame, database: str) -> None:
    """Add ``bars``; a bar of a known symbol and time replaces the stored one.

    Only the months that ``bars`` lie in are read and written (UTC); a time that is no number has a
    month of its own, NULL. Of several new bars of one symbol and time the one with the highest
    close, then volume, is taken, so the result depends on no order. Adding the same bars again
    changes nothing; no bars change nothing. Loads of one database run one after another.
    """
    spark, table = bars.sparkSession, bars_table(database)
    day = F.date_from_unix_date(F.floor(F.expr("try_cast(timestamp AS bigint)") / 86_400_000).cast("int"))
    chosen = bars.groupBy(*ORDER).agg(F.max(F.struct("close", "volume")).alias("bar"))
    new = stored(
        chosen.select(*ORDER, "bar.close", "bar.volume", F.date_format(day, "yyyy-MM").alias("month"))
    )
    months = {month for (month,) in new.select("month").distinct().collect()}
    if not months:
        return
    rows = new
    if spark.catalog.tableExists(table):
        held = spark.table(table).where(on_partition("month", months))
        known = new.select(*[F.col(name).alias(f"new_{name}") for name in ORDER])
        same = F.col("symbol").eqNullSafe(F.col("new_symbol")) & F.col("timestamp").eqNullSafe(
            F.col("new_timestamp")
        )
        rows = new.unionByName(held.join(known, same, "left_anti"))
    replace_partitions(rows.hint("rebalance", "month"), table, BY_MONTH, ORDER)


def stored_bars(spark: SparkSession, database: str) -> DataFrame:
    """All stored bars, in the layout of the source."""
    return spark.table(bars_table(database)).select("timestamp", "symbol", "close", "volume")

