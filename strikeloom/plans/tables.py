"""Strategies in SQL: every registered one as a view and a table function, and pandas ones by chain."""

from collections.abc import Iterator, Mapping
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strikeloom.operators.chains import as_doubles, strike_prices
from strikeloom.operators.lookback import lookback
from strikeloom.plans.custom import FrameFunction
from strikeloom.plans.registry import STRATEGIES, Strategy
from strikeloom.schema import CHAIN_KEY

STRIKES = "strategy_strikes"


def register_strategies(
    spark: SparkSession,
    silver: DataFrame,
    registry: Mapping[str, Strategy] = STRATEGIES,
    anchor: date | None = None,
) -> list[str]:
    """Make the strategies of ``registry`` known to this session's SQL; returns the views' names.

    Each is a view of its name with the strategy's own lookback, and a table function
    ``<name>_between(first, last)`` over it. Both are plans, not results: Spark prunes columns
    and pushes conditions on trade dates down to the scan of silver, and nothing runs before a
    query does. ``strategy_strikes`` has one row per chain, type and strike, for table functions
    that take whole chains.
    """
    for name, strategy in registry.items():
        window = lookback(silver, strategy.lookback_days, anchor)
        signals = strategy.signals(window.select(*strategy.columns))
        signals.createOrReplaceTempView(name)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in signals.schema)
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}_between(first DATE, last DATE) "
            f"RETURNS TABLE ({columns}) "
            f"RETURN SELECT * FROM `{name}` WHERE trade_date BETWEEN first AND last"
        )
    as_doubles(strike_prices(silver)).createOrReplaceTempView(STRIKES)
    return list(registry)


def register_chain_function(
    spark: SparkSession, name: str, logic: FrameFunction, schema: str | StructType
) -> None:
    """Make a pandas function of one chain a SQL table function, to be given a table by chain:

    ``SELECT * FROM name(TABLE(SELECT * FROM strategy_strikes) PARTITION BY (underlying,
    trade_date, expiry_date))``

    It is called once per partition with all of its rows as a frame, so it should be given rows
    that Spark has combined, such as ``strategy_strikes``: those are as many as a chain lists
    strikes. Chains with a NULL key part are partitions too.
    """

    class ByChain:
        def __init__(self) -> None:
            self.rows: list[dict] = []

        def eval(self, row: Row) -> None:
            self.rows.append(row.asDict())

        def terminate(self) -> Iterator[tuple]:
            if self.rows:
                yield from logic(pd.DataFrame(self.rows)).itertuples(index=False, name=None)

    spark.udtf.register(name, F.udtf(ByChain, returnType=schema))


def by_chain(name: str, rows: str = STRIKES) -> str:
    """SQL that runs a registered chain function over ``rows``, one call per chain."""
    return f"SELECT * FROM {name}(TABLE(SELECT * FROM {rows}) PARTITION BY ({', '.join(CHAIN_KEY)}))"
