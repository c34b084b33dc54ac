"""Signals by price threshold: cheap calls and puts are bought, everything else is held."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikeloom.operators.chains import as_doubles
from strikeloom.schema import THRESHOLD_COLUMNS

# Price limit, label and input columns of the strategy.
CHEAP_BELOW = 5.0
LABEL = "LAYMAN_SPY"
INPUT = ("symbol", "trade_date", "expiry_date", "strike_price", "option_type", "mid_price")


def threshold_signals(
    silver: DataFrame, underlying: str = "SPY", only_underlying: bool = False
) -> DataFrame:
    """One signal per quote; a missing mid price means HOLD.

    Every row carries the configured ``underlying`` and, by default, rows of all underlyings are
    labelled so. ``only_underlying`` keeps just the rows that really belong to it.
    """
    if only_underlying:
        silver = silver.where(F.col("underlying") == underlying)
    quotes = as_doubles(silver.select(*INPUT))
    cheap = F.col("mid_price") < CHEAP_BELOW
    signal = (
        F.when(cheap & (F.col("option_type") == "CALL"), "BUY_CALL")
        .when(cheap & (F.col("option_type") == "PUT"), "BUY_PUT")
        .otherwise("HOLD")
    )
    labelled = quotes.withColumns(
        {"signal": signal, "strategy_name": F.lit(LABEL), "underlying": F.lit(underlying)}
    )
    return labelled.select(*THRESHOLD_COLUMNS)
