"""Steps over option chains: one price per strike, strike ranks, legs and chain validity."""

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strikeloom.schema import CHAIN_KEY, DOUBLE_COLUMNS


def as_doubles(frame: DataFrame) -> DataFrame:
    """Cast the known decimal columns that are present to double."""
    names = [name for name in DOUBLE_COLUMNS if name in frame.columns]
    return frame.withColumns({name: F.col(name).cast("double") for name in names})


def has_whole_key() -> Column:
    """Whether a row belongs to a chain: chains with a NULL key part never match anything."""
    return reduce(and_, [F.col(name).isNotNull() for name in CHAIN_KEY])


def strike_prices(silver: DataFrame, further: Mapping[str, Column] | None = None) -> DataFrame:
    """Mean mid price per chain, option type and strike, over all minutes and contracts.

    ``further`` names other aggregates to compute along with it.

    Strikes without any usable mid are dropped. Sums stay decimal, hence exact and independent of
    row order. Spark combines rows before the shuffle, so a contract holding a large share of all
    quotes still arrives as one partial row per task. NULLs are dealt with on the aggregated rows:
    conditions on the input would have its derived columns computed twice.
    """
    mean = F.try_divide(F.sum("mid_price").cast("double"), F.count("mid_price"))
    strikes = silver.groupBy(*CHAIN_KEY, "option_type", "strike_price")
    others = [value.alias(name) for name, value in (further or {}).items()]
    return strikes.agg(mean.alias("mid_price"), *others).where(F.col("mid_price").isNotNull())


def rank_strikes(strikes: DataFrame) -> DataFrame:
    """Dense rank per chain and type: calls from the highest strike down, puts from the lowest up.

    An unknown strike ranks behind all known ones.
    """
    outward = F.when(F.col("option_type") == "CALL", -F.col("strike_price")).otherwise(
        F.col("strike_price")
    )
    window = Window.partitionBy(*CHAIN_KEY, "option_type").orderBy(outward.asc_nulls_last())
    return strikes.withColumn("strike_rank", F.dense_rank().over(window))


def outer_two(strikes: DataFrame) -> DataFrame:
    """The two outermost strikes per chain and type: the short (1) and the long (2) leg.

    Spark pushes the rank limit below the shuffle, so each task sends at most two rows per chain
    and type, however many strikes a chain has.
    """
    return rank_strikes(strikes).where(F.col("strike_rank") <= 2)


def valid_chains(silver: DataFrame) -> DataFrame:
    """Chains with at least two call and two put strikes, and how many they have.

    Counted over distinct strikes in two combining steps, which spares the row expansion that two
    ``count(distinct ...)`` in one aggregate would cause.
    """
    distinct = silver.select(*CHAIN_KEY, "option_type", "strike_price").distinct()

    def strikes_of(kind: str) -> Column:
        of_kind = (F.col("option_type") == kind) & has_whole_key()
        return F.count(F.when(of_kind, F.col("strike_price")))

    counts = distinct.groupBy(*CHAIN_KEY).agg(
        strikes_of("CALL").alias("num_calls"), strikes_of("PUT").alias("num_puts")
    )
    return counts.where((F.col("num_calls") >= 2) & (F.col("num_puts") >= 2))


def rows_of_valid_chains(strikes: DataFrame) -> DataFrame:
    chains = valid_chains(strikes).select(*CHAIN_KEY)
    return strikes.join(chains, list(CHAIN_KEY), "left_semi")
