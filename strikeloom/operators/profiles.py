"""Profiles by sketches: made once per group of rows, merged when they are asked for.

A profile row has counts, minimum and maximum, a quantile sketch of each number column, and a
distinct and a heavy-hitter sketch of each item column. All of them merge exactly or within the
sketch's error, so the profile of many dates comes from one small row per date.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of the quantile sketches: ranks are off by less than 1 % with 99 % confidence.
QUANTILE_SIZE = 400
# log2 of the distinct sketch's buckets: 1.6 % standard error.
DISTINCT_BITS = 12
# Items that a heavy-hitter sketch tracks: an item over 1 % of the rows is always among them.
TRACKED = 1_000


def sketched(
    frame: DataFrame, numbers: Sequence[str], items: Sequence[str], *by: str
) -> DataFrame:
    """One profile row per value of ``by``; groups combine on the map side, hot ones too."""
    profile = [F.count(F.lit(1)).alias("row_count")]
    for name in numbers:
        value = F.col(name).cast("double")
        profile += [
            F.count(name).alias(f"{name}_count"),
            F.min(value).alias(f"{name}_min"),
            F.max(value).alias(f"{name}_max"),
            F.kll_sketch_agg_double(value, QUANTILE_SIZE).alias(f"{name}_kll"),
        ]
    for name in items:
        value = F.col(name).cast("string")
        profile += [
            F.count(name).alias(f"{name}_count"),
            F.hll_sketch_agg(value, DISTINCT_BITS).alias(f"{name}_hll"),
            F.expr(f"approx_top_k_accumulate(cast(`{name}` AS string), {TRACKED})").alias(f"{name}_top"),
        ]
    return frame.groupBy(*by).agg(*profile)


def merged(profiles: DataFrame, numbers: Sequence[str], items: Sequence[str], *by: str) -> DataFrame:
    """Profile rows of finer groups as one per value of ``by``; without ``by`` one row for all.

    No profile rows give no row: heavy-hitter sketches cannot be combined from nothing.
    """
    profile = [F.sum("row_count").alias("row_count")]
    for name in numbers:
        profile += [
            F.sum(f"{name}_count").alias(f"{name}_count"),
            F.min(f"{name}_min").alias(f"{name}_min"),
            F.max(f"{name}_max").alias(f"{name}_max"),
            F.kll_merge_agg_double(f"{name}_kll", QUANTILE_SIZE).alias(f"{name}_kll"),
        ]
    for name in items:
        profile += [
            F.sum(f"{name}_count").alias(f"{name}_count"),
            F.hll_union_agg(f"{name}_hll").alias(f"{name}_hll"),
            F.expr(f"approx_top_k_combine(`{name}_top`, {TRACKED})").alias(f"{name}_top"),
        ]
    if by:
        return profiles.groupBy(*by).agg(*profile)
    return profiles.groupBy(F.lit(0).alias("_all")).agg(*profile).drop("_all")


def quantile(name: str, share: float) -> Column:
    """Estimated quantile of a number column of a profile row; NULL where it has no values."""
    some = F.col(f"{name}_count") > 0
    return F.when(some, F.kll_sketch_get_quantile_double(f"{name}_kll", F.lit(share)))


def distinct_count(name: str) -> Column:
    """Estimated number of different values of an item column, NULL not counted."""
    return F.hll_sketch_estimate(f"{name}_hll")


def most_frequent(name: str, n: int = 10) -> Column:
    """Array of (item, count) of an item column, most frequent first; a NULL item may be among them."""
    return F.expr(f"approx_top_k_estimate(`{name}_top`, {n})")
