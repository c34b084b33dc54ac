"""Option quotes derived from the ``lineitem`` table, for checks and benchmarks.

The check tables hold no option quotes. This projection gives every line item a contract symbol, a
two-sided quote and the name of the file it would have come in: 40 trade dates with three expiries
each. It only maps rows, so its output grows with ``lineitem``.
"""

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strikeloom.schema import QUOTE_SCHEMA

# Fixed values of the derivation; the check SQL states the same ones.
TRADE_DATES = [date(2025, 1, 1) + timedelta(days) for days in range(40)]
TERMS = (0, 7, 30)
ROOTS = ("SPX", "SPXW", "NDX", "RUT", "AAPL", "MSFT")
RARE_ROOT = "VIX"
FIRST_MINUTE = 14 * 3600 + 31 * 60


def _pick(values: Sequence, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(value) for value in values]), index.cast("int") + 1)


def _root() -> Column:
    rare = (F.col("l_quantity") == 50) & (F.col("l_discount") == 0.1)
    return F.when(rare, RARE_ROOT).otherwise(_pick(ROOTS, F.col("l_suppkey") % len(ROOTS)))


def quotes_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    day = F.col("l_orderkey") % len(TRADE_DATES)
    term = F.col("l_orderkey") % len(TERMS)
    expiries = [f"{d + timedelta(days):%y%m%d}" for d in TRADE_DATES for days in TERMS]
    names = [f"opra-pillar-{d:%Y%m%d}.cbbo-1m.csv" for d in TRADE_DATES]

    side = F.when(F.col("l_linenumber") % 2 == 0, "C").otherwise("P")
    strike = (1000 + F.col("l_partkey") % 20 * 25) * 100
    midnight = (day + (TRADE_DATES[0] - date(1970, 1, 1)).days) * 86400
    columns = {
        "ts_recv": F.timestamp_seconds(midnight + FIRST_MINUTE + F.col("l_partkey") % 390 * 60),
        "rtype": F.lit(193),
        "publisher_id": F.lit(30),
        "instrument_id": F.col("l_orderkey"),
        "side": F.lit("N"),
        "size": F.lit(0),
        "flags": F.lit(200),
        "bid_px_00": F.when(F.col("l_tax") == 0.08, 0.0).otherwise(F.col("l_quantity")),
        "ask_px_00": F.col("l_quantity") + F.col("l_discount"),
        "bid_sz_00": F.col("l_quantity"),
        "ask_sz_00": F.col("l_linenumber"),
        "bid_pb_00": F.lit(0),
        "ask_pb_00": F.lit(0),
        "symbol": F.concat(
            F.rpad(_root(), 6, " "),
            _pick(expiries, day * len(TERMS) + term),
            side,
            F.lpad(strike.cast("string"), 8, "0"),
        ),
    }
    quotes = [
        columns.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
        for field in QUOTE_SCHEMA
    ]
    return lineitem.select(*quotes, _pick(names, day).alias("file_name"))


def bar_replies_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily-bar replies, one per supplier and ship month; every tenth supplier has no results.

    A reply holds at most the days of one month, so collecting its bars stays small.
    """
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    shipped = F.to_date("l_shipdate")
    daily = lineitem.groupBy("l_suppkey", shipped.alias("day")).agg(
        F.max("l_extendedprice").alias("c"), F.sum("l_quantity").alias("v")
    )
    bar = F.struct((F.unix_date("day").cast("bigint") * 86_400_000).alias("t"), "c", "v")
    replies = daily.groupBy("l_suppkey", F.trunc("day", "month").alias("month")).agg(
        F.collect_list(bar).alias("results")
    )
    ticker = F.concat(F.lit("O:S"), F.col("l_suppkey"))
    return replies.select(
        ticker.alias("ticker"),
        F.when(F.col("l_suppkey") % 10 != 0, F.col("results")).alias("results"),
    )
