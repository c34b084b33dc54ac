"""On-demand reports over the stored layers."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def option_type_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("option_type").agg(F.count(F.lit(1)).alias("row_count"))


def distinct_underlyings(silver: DataFrame) -> DataFrame:
    return silver.select("underlying").distinct()


def signal_distribution(gold: DataFrame) -> DataFrame:
    """Signals per date, newest date first."""
    counts = gold.groupBy("trade_date", "signal").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.desc("trade_date"), "signal")


def date_coverage(silver: DataFrame) -> DataFrame:
    counts = silver.groupBy("trade_date").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.desc("trade_date"))


def latest_dates(silver: DataFrame, n: int = 5) -> DataFrame:
    return silver.select("trade_date").distinct().orderBy(F.desc("trade_date")).limit(n)


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        frame.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("row_count"))
        for name, frame in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def range_profile(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Minimum, maximum, non-null and null count of each column, in one pass over the table."""
    profile = [F.count(F.lit(1)).alias("row_count")]
    for name in columns:
        profile += [
            F.min(name).alias(f"{name}_min"),
            F.max(name).alias(f"{name}_max"),
            F.count(name).alias(f"{name}_count"),
            F.count_if(F.col(name).isNull()).alias(f"{name}_nulls"),
        ]
    return frame.agg(*profile)


def head(frame: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """First rows under a stated order, so the sample is stable."""
    return frame.orderBy(*order).limit(n)
