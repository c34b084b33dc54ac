"""Strategies asked for in SQL."""

from decimal import Decimal
from uuid import uuid4

import pandas as pd
from helpers import csv_line, day, silver, write_csv

from strikeloom import jobs
from strikeloom.plans import tables
from strikeloom.plans.registry import STRATEGIES
from strikeloom.sinks.catalog import create_database
from strikeloom.sinks.layers import silver_table

EXPIRY = day("2025-02-21")


def chains(spark):
    strikes = [("CALL", "10", "3"), ("CALL", "11", "2"), ("PUT", "8", "1"), ("PUT", "9", "2.5")]
    rows = [
        (root, day(date), EXPIRY, kind, Decimal(strike), Decimal(mid))
        for root in ("SPY", None)
        for date in ("2025-01-28", "2025-01-29")
        for kind, strike, mid in strikes
    ]
    return silver(spark, rows)


def test_view_and_function_give_the_strategy(spark):
    registry = {"IronCondorStrategy": STRATEGIES["IronCondorStrategy"]}
    frame = chains(spark)
    assert tables.register_strategies(spark, frame, registry) == ["IronCondorStrategy"]
    wanted = STRATEGIES["IronCondorStrategy"].signals(frame)
    assert sorted(spark.table("IronCondorStrategy").collect()) == sorted(wanted.collect())
    some = spark.sql("SELECT * FROM IronCondorStrategy_between(DATE'2025-01-29', DATE'2025-01-29')")
    assert some.columns == wanted.columns
    assert [row.trade_date for row in some.collect()] == [day("2025-01-29")]


def test_conditions_reach_the_scan(spark, tmp_path):
    database = f"sql_{uuid4().hex}"
    create_database(spark, database, str(tmp_path / "db"))
    for d in ("20250128", "20250129"):
        write_csv(tmp_path / "in", f"opra-pillar-{d}.cbbo-1m.csv", [csv_line("SPXW  250128C05000000")])
    jobs.load(spark, str(tmp_path / "in"), database, bootstrap=True)
    tables.register_strategies(spark, spark.table(silver_table(database)), anchor=day("2025-01-29"))
    rows = spark.sql("SELECT symbol, signal FROM LaymanSPYStrategy_between(DATE'2025-01-29', DATE'2025-01-29')")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2025-01-29" in plan.split("PartitionFilters")[1]
    assert "bid_px_00" not in plan and len(rows.collect()) == 1


def test_pandas_function_sees_whole_chains(spark):
    tables.register_strategies(spark, chains(spark), {})

    def counted(chain: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"trade_date": chain["trade_date"].head(1), "n": len(chain), "top": chain["strike_price"].max()})

    tables.register_chain_function(spark, "counted_chain", counted, "trade_date date, n bigint, top double")
    found = sorted(tuple(row) for row in spark.sql(tables.by_chain("counted_chain")).collect())
    assert found == sorted([(day("2025-01-28"), 4, 11.0), (day("2025-01-29"), 4, 11.0)] * 2)
    nothing = spark.sql(tables.by_chain("counted_chain", "(SELECT * FROM strategy_strikes WHERE false)"))
    assert nothing.collect() == []
