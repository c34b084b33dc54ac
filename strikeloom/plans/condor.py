"""Four-leg iron condors per chain (underlying, trade date, expiry).

Short legs take the outermost strikes (highest call, lowest put), long legs the next ones inward.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strikeloom.functions.money import round_cents_half_even
from strikeloom.operators.chains import has_whole_key, outer_two, strike_prices
from strikeloom.schema import CHAIN_KEY, CONDOR_COLUMNS

# Label, input columns, and the type and rank that make each leg.
LABEL = "IRON_CONDOR"
INPUT = (*CHAIN_KEY, "strike_price", "option_type", "mid_price")
LEGS = {
    "short_call": ("CALL", 1),
    "long_call": ("CALL", 2),
    "short_put": ("PUT", 1),
    "long_put": ("PUT", 2),
}


def _is_leg(leg: str) -> Column:
    kind, rank = LEGS[leg]
    return (F.col("option_type") == kind) & (F.col("strike_rank") == rank)


def _finish(four_legs: DataFrame) -> DataFrame:
    shorts = F.col("price_short_put") + F.col("price_short_call")
    longs = F.col("price_long_put") + F.col("price_long_call")
    finished = four_legs.withColumns(
        {"net_credit": round_cents_half_even(shorts - longs), "strategy_name": F.lit(LABEL)}
    )
    return finished.withColumnRenamed("expiry_date", "expiration").select(*CONDOR_COLUMNS)


def condor_legs(silver: DataFrame) -> DataFrame:
    """Up to four rows per chain: the two outermost strikes of either type with their mean mid."""
    legs = outer_two(strike_prices(silver.select(*INPUT)))
    return legs.withColumn("strike_price", F.col("strike_price").cast("double"))


def iron_condors(silver: DataFrame) -> DataFrame:
    """One condor per chain that has all four legs, pivoting the legs in a single aggregate."""
    picks = []
    for leg in LEGS:
        chosen = _is_leg(leg) & has_whole_key()
        picks += [
            F.max(F.when(chosen, F.col("strike_price"))).alias(f"strike_{leg}"),
            F.max(F.when(chosen, F.col("mid_price"))).alias(f"price_{leg}"),
        ]
    pivoted = condor_legs(silver).groupBy(*CHAIN_KEY).agg(*picks)
    complete = reduce(and_, [F.col(f"strike_{leg}").isNotNull() for leg in LEGS])
    return _finish(pivoted.where(complete))


def iron_condors_by_joins(silver: DataFrame) -> DataFrame:
    """The same condors as a four-way inner join of the legs on the chain key."""
    legs = condor_legs(silver)
    sides = [
        legs.where(_is_leg(leg) & F.col("strike_price").isNotNull()).select(
            *CHAIN_KEY,
            F.col("strike_price").alias(f"strike_{leg}"),
            F.col("mid_price").alias(f"price_{leg}"),
        )
        for leg in LEGS
    ]
    return _finish(reduce(lambda left, right: left.join(right, list(CHAIN_KEY)), sides))
