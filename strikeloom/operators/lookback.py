"""The window of trade dates a strategy looks at, anchored on the newest date in the data."""

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strikeloom.sinks.catalog import partition_values


def max_trade_date(silver: DataFrame) -> DataFrame:
    return silver.agg(F.max("trade_date").alias("max_trade_date"))


def newest_stored_date(spark: SparkSession, table: str) -> date | None:
    """Newest ``trade_date`` with rows in a table partitioned by it, without scanning the table.

    The catalog lists the dates; the first non-empty one from the newest down is the answer, so in
    practice one partition is opened.
    """
    stored = spark.table(table)
    days = sorted(map(date.fromisoformat, partition_values(spark, table)), reverse=True)
    return next((d for d in days if not stored.where(F.col("trade_date") == d).isEmpty()), None)


def lookback(silver: DataFrame, days: int, anchor: date | None = None) -> DataFrame:
    """Rows of the anchor date and of the ``days`` calendar days before it.

    The anchor is the newest date over all underlyings. Given as a date it prunes partitions at
    planning time; left out it becomes a scalar subquery, which prunes them at run time.
    """
    if anchor is not None:
        return silver.where(F.col("trade_date") >= F.lit(anchor - timedelta(days=days)))
    newest = max_trade_date(silver).scalar()
    return silver.where(F.col("trade_date") >= F.date_sub(newest, days))
