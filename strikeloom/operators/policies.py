"""Filters a load can switch on; each takes and returns silver rows."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zero_dte(silver: DataFrame) -> DataFrame:
    """Contracts that expire on the day they are quoted."""
    return silver.where(F.col("trade_date") == F.col("expiry_date"))


def liquidity(silver: DataFrame) -> DataFrame:
    """Quotes with both sides present; without this policy one-sided quotes are kept."""
    return silver.where((F.col("bid_px_00") > 0) & (F.col("ask_px_00") > 0))


POLICIES = {"zero_dte": zero_dte, "liquidity": liquidity}


def named(names: Iterable[str]) -> list:
    names = list(names)
    unknown = [name for name in names if name not in POLICIES]
    if unknown:
        raise ValueError(f"unknown policies {unknown}; known: {sorted(POLICIES)}")
    return [POLICIES[name] for name in names]
