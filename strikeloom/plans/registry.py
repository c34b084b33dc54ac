"""Strategies a run can select by name."""

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame

from strikeloom.plans import condor, threshold


@dataclass(frozen=True)
class Strategy:
    """Silver columns wanted, calendar days of lookback, and the frame function itself.

    ``regroup`` gathers the output by trade date before it is stored. Set it where signals come
    out of a shuffle and are few; leave it off where they come straight from the silver scan.
    """

    columns: tuple[str, ...]
    signals: Callable[[DataFrame], DataFrame]
    lookback_days: int = 7
    regroup: bool = False


# Names, lookbacks and underlyings of the strategies, and those run by default.
STRATEGIES = {
    "LaymanSPYStrategy": Strategy(
        columns=threshold.INPUT,
        signals=partial(threshold.threshold_signals, underlying="SPY"),
        lookback_days=3,
    ),
    "LaymanQQQStrategy": Strategy(
        columns=threshold.INPUT,
        signals=partial(threshold.threshold_signals, underlying="QQQ"),
        lookback_days=3,
    ),
    "IronCondorStrategy": Strategy(
        columns=condor.INPUT,
        signals=condor.iron_condors,
        lookback_days=30,
        regroup=True,
    ),
}
ACTIVE = ("IronCondorStrategy",)
