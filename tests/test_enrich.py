from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import bronze
from strikeloom.functions import osi
from strikeloom.functions.money import round_cents_half_even
from strikeloom.operators.enrich import enrich, with_underlying_from
from strikeloom.operators.policies import liquidity, named, zero_dte
from strikeloom.schema import QUOTE_SCHEMA, SILVER_HEAD, SILVER_TAIL

MARCH = "opra-pillar-20240305.cbbo-1m.csv"

CASES = {
    "plain call": (
        ("SPX   240419C01000000", 5014.3, 5031.1, MARCH),
        ("SPY", date(2024, 3, 5), date(2024, 4, 19), "CALL", 1000, "5022.7"),
    ),
    "fractional strike": (
        ("SPXW  240419P05600500", 1.0, 1.2, MARCH),
        ("SPY", date(2024, 3, 5), date(2024, 4, 19), "PUT", "5600.5", "1.1"),
    ),
    "sub-cent quote is rounded per side": (
        ("SPX   240419C01000000", 0.125, 0.05, MARCH),
        ("SPY", date(2024, 3, 5), date(2024, 4, 19), "CALL", 1000, "0.09"),
    ),
    "decimal text decides ties": (
        ("SPX   240419C01000000", 1.005, 1.0, MARCH),
        ("SPY", date(2024, 3, 5), date(2024, 4, 19), "CALL", 1000, "1.005"),
    ),
    "malformed symbol": (
        ("BAD", 1.0, 1.0, MARCH),
        ("BAD", date(2024, 3, 5), None, "PUT", None, 1),
    ),
    "missing symbol": ((None, 1.0, 1.0, MARCH), (None, date(2024, 3, 5), None, "PUT", None, 1)),
    "impossible expiry": (
        ("SPX   240230C01000000", 1.0, 1.0, MARCH),
        ("SPY", date(2024, 3, 5), None, "CALL", 1000, 1),
    ),
    "unmapped root, no quote": (
        ("AAPL  240419X00190000", None, None, MARCH),
        ("AAPL", date(2024, 3, 5), date(2024, 4, 19), "PUT", 190, None),
    ),
    "one side missing": (
        ("NDXP  240419C00190000", 1.0, None, MARCH),
        ("QQQ", date(2024, 3, 5), date(2024, 4, 19), "CALL", 190, None),
    ),
    "file name without date": (
        ("RUTW  240419C00190000", 1.0, 1.01, "nodate.csv"),
        ("IWM", None, date(2024, 4, 19), "CALL", 190, "1.005"),
    ),
    "file name with an impossible date": (
        ("DJX   240419C00190000", 1.0, 1.0, "q-20241345.csv"),
        ("DIA", None, date(2024, 4, 19), "CALL", 190, 1),
    ),
    "first eight digits count": (
        ("VIX   990419C00190000", 0.0, 0.05, "q-202403051.20250101.csv"),
        ("VXX", date(2024, 3, 5), date(2099, 4, 19), "CALL", 190, "0.025"),
    ),
    "price out of range": (
        ("SPX   240419C01000000", 1e12, 1.0, MARCH),
        ("SPY", date(2024, 3, 5), date(2024, 4, 19), "CALL", 1000, None),
    ),
    "price not a number": (
        ("SPX   240419C01000000", float("nan"), 1.0, MARCH),
        ("SPY", date(2024, 3, 5), date(2024, 4, 19), "CALL", 1000, None),
    ),
}


@pytest.fixture(scope="module")
def enriched(spark):
    rows = enrich(bronze(spark, [given for given, _ in CASES.values()])).collect()
    return dict(zip(CASES, rows))


@pytest.mark.parametrize("case", CASES)
def test_enriched_row(enriched, case):
    row, (underlying, traded, expiry, kind, strike, mid) = enriched[case], CASES[case][1]
    assert (row.underlying, row.trade_date, row.expiry_date, row.option_type) == (
        underlying,
        traded,
        expiry,
        kind,
    )
    assert row.strike_price == (None if strike is None else Decimal(strike))
    assert row.mid_price == (None if mid is None else Decimal(mid))


def test_layout_types_and_pass_through(spark):
    frame = bronze(spark, []).withColumn("venue", F.lit("X"))
    silver = enrich(frame)
    middle = [c for c in QUOTE_SCHEMA.fieldNames() if c != "symbol"]
    assert silver.columns == [*SILVER_HEAD, *middle, "venue", *SILVER_TAIL]
    types = dict(silver.dtypes)
    assert types["strike_price"] == "decimal(15,7)"
    assert types["mid_price"] == "decimal(15,6)"


def test_dates_equal_pattern_parsing(spark):
    """The quick date casts accept and refuse exactly what parsing by pattern does."""
    texts = [
        "240419", "240229", "230229", "000101", "991231", "241301", "240100", "240132", "2404",
        "24041", "24041 ", "24041T", "2404 1", "2404T1", " 40419", "24 419", "24-419", "2-0419",
        "244-19", "2404-1", "24041-", "abcdef", "24o419", "+40419", "-40419", "", "      ",
        "24041٣", "２40419", "24041:", "24041/", "24041Z",
    ]
    names = ["", "a", "20250128", "x20250128y", "2025012", "00001231", "20250229", "99999999",
             "a1234567b20250128", "20251301.csv", "2025-01-28.csv"]
    symbols = [f"SPX   {t}C01000000" for t in texts] + [f"SPX   {t}" for t in texts]
    by_pattern = F.try_to_date(F.substring("text", 7, 6), "yyMMdd")
    files_by_pattern = F.try_to_date(F.regexp_extract("text", r"(\d{8})", 1), "yyyyMMdd")
    for given, quick, expected in (
        (symbols, osi.expiry_date, by_pattern),
        (names, osi.trade_date, files_by_pattern),
    ):
        frame = spark.createDataFrame([(t,) for t in given], "text string")
        got = frame.select("text", quick(F.col("text")).alias("quick"), expected.alias("expected"))
        odd = got.where("NOT quick <=> expected").selectExpr(
            "text", "cast(quick AS string)", "cast(expected AS string)"
        )
        assert odd.collect() == []
        assert got.where("quick IS NOT NULL").count() > 2


def test_decimals_equal_division(spark):
    """Multiplying by exact decimals gives what dividing gives, for odd strike text as well."""
    texts = ["05600500", "00000001", "99999999", "12.345  ", "   1.5  ", "-1000000", "1e3 ", "1"]
    symbols = spark.createDataFrame([(f"SPX   240419C{t}",) for t in texts], "symbol string")
    divided = F.substring("symbol", 14, 8).try_cast("decimal(10,2)") / 1000
    got = osi.strike_price(F.col("symbol"))
    rows = symbols.select(got.alias("got"), divided.alias("e")).collect()
    assert [r.got for r in rows] == [r.e for r in rows]
    assert all(r.got is not None for r in rows)

    sides = (0.0, 0.005, 0.01, 0.015, 1.005, 2.675, 99999999.99)
    pairs = [(bid, ask) for bid in sides for ask in sides]
    prices = spark.createDataFrame(pairs, "bid double, ask double")
    divided = (F.col("bid").cast("decimal(10,2)") + F.col("ask").cast("decimal(10,2)")) / 2
    got = osi.mid_price(F.col("bid"), F.col("ask"))
    assert all(r.got == r.e for r in prices.select(got.alias("got"), divided.alias("e")).collect())


def test_policies(spark):
    rows = [
        ("SPX   240305C01000000", 0.0, 0.05, MARCH),
        ("SPX   240305C01100000", 0.1, 0.05, MARCH),
        ("SPX   240419C01200000", 0.1, 0.05, MARCH),
        ("SPX   240419C01300000", None, 0.05, MARCH),
    ]
    frame = bronze(spark, rows)

    def strikes(*policies):
        kept = enrich(frame, policies=policies).select(F.col("strike_price").cast("int"))
        return sorted(strike for (strike,) in kept.collect())

    assert strikes() == [1000, 1100, 1200, 1300]
    assert strikes(zero_dte) == [1000, 1100]
    assert strikes(liquidity) == [1100, 1200]
    assert strikes(*named(["zero_dte", "liquidity"])) == [1100]
    assert strikes(liquidity, zero_dte) == [1100]
    with pytest.raises(ValueError, match="unknown policies"):
        named(["zero_dte", "nope"])


def test_underlying_from_dimension_keeps_every_quote_once(spark):
    frame = bronze(spark, [("SPX   240419C01000000", 1.0, 1.0, MARCH), ("ZZ", 1.0, 1.0, MARCH)] * 3)
    dimension = spark.createDataFrame(
        [("SPX", "SPY"), ("SPX", "SPY"), ("NDX", "QQQ")], "root string, underlying string"
    )
    mapped = with_underlying_from(frame, dimension).select("underlying").collect()
    assert sorted(u for (u,) in mapped) == ["SPY"] * 3 + ["ZZ"] * 3


def test_other_mapping_and_none(spark):
    frame = bronze(spark, [("SPX   240419C01000000", 1.0, 1.0, MARCH)])
    assert enrich(frame, {"SPX": "INDEX"}).first().underlying == "INDEX"
    assert enrich(frame, {}).first().underlying == "SPX"


def test_cents_round_half_to_even(spark):
    amounts = spark.createDataFrame([(0.125,), (0.375,), (-0.125,), (1.0,)], "x double")
    rounded = amounts.select(round_cents_half_even(F.col("x"))).collect()
    assert [r[0] for r in rounded] == [0.12, 0.38, -0.12, 1.0]
