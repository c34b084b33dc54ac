"""Hooks for strategies written in pandas. Prefer plain DataFrame functions where they suffice."""

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strikeloom.operators.chains import as_doubles, strike_prices
from strikeloom.schema import CHAIN_KEY

FrameFunction = Callable[[pd.DataFrame], pd.DataFrame]


def _by_time(pick: Callable[[Column, Column], Column]) -> Callable[[Column], Column]:
    """Value at the first or last time; of several at that time the smallest or largest."""
    return lambda value: pick(value, F.when(value.isNotNull(), F.struct("ts_recv", value)))


# How the minute rows of a strike become one value; NULLs count for none of them.
AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "first": _by_time(F.min_by),
    "last": _by_time(F.max_by),
    "min": F.min,
    "max": F.max,
    "mean": F.mean,
    "sum": F.sum,
}


def per_chain(
    logic: FrameFunction, schema: str, columns: Mapping[str, tuple[str, str]] | None = None
) -> Callable[[DataFrame], DataFrame]:
    """Run ``logic`` once per chain on one row per type and strike.

    A row has the chain key, type, strike and mean mid price, and what ``columns`` declares:
    ``{"low_bid": ("bid_px_00", "min")}`` names a silver column and one of ``AGGREGATES`` (``first``
    and ``last`` go by ``ts_recv``). Minute rows are combined by Spark before and after the
    shuffle, so what reaches one Python call is bounded by the strikes listed in a chain, however
    many quotes they had.
    """
    declared = {
        name: AGGREGATES[how](F.col(source)) for name, (source, how) in (columns or {}).items()
    }

    def signals(silver: DataFrame) -> DataFrame:
        strikes = as_doubles(strike_prices(silver, declared))
        return strikes.groupBy(*CHAIN_KEY).applyInPandas(logic, schema)

    return signals


def per_batch(logic: FrameFunction, schema: str) -> Callable[[DataFrame], DataFrame]:
    """Run row-wise ``logic`` on Arrow batches of quotes; no shuffle."""

    def signals(silver: DataFrame) -> DataFrame:
        return as_doubles(silver).mapInPandas(lambda batches: map(logic, batches), schema)

    return signals
