from collections import defaultdict
from datetime import date
from decimal import Decimal
from itertools import product
from random import Random

import pytest
from pyspark.sql import functions as F

from helpers import day, silver
from strikeloom.operators import chains
from strikeloom.operators.lookback import lookback
from strikeloom.plans.condor import condor_legs, iron_condors, iron_condors_by_joins
from strikeloom.plans.threshold import threshold_signals
from strikeloom.schema import CONDOR_COLUMNS, THRESHOLD_COLUMNS

KEY = ("SPY", day("2025-01-28"), day("2025-02-21"))


def chain(quotes, key=KEY):
    return [(*key, kind, s if s is None else Decimal(s), m if m is None else Decimal(m))
            for kind, s, m in quotes]


FOUR = [("CALL", 110, 1), ("CALL", 120, 2), ("PUT", 90, 3), ("PUT", 80, 5)]
BOTH_FORMS = pytest.mark.parametrize("form", [iron_condors, iron_condors_by_joins])


@BOTH_FORMS
def test_legs_are_the_outermost_strikes(spark, form):
    quotes = [*FOUR, ("CALL", 100, 9), ("PUT", 95, 9)]
    frame = form(silver(spark, chain(quotes)))
    assert frame.columns == list(CONDOR_COLUMNS)
    assert [tuple(r) for r in frame.collect()] == [
        (*KEY, 120.0, 2.0, 110.0, 1.0, 80.0, 5.0, 90.0, 3.0, 3.0, "IRON_CONDOR")
    ]


@BOTH_FORMS
@pytest.mark.parametrize(
    "quotes",
    [
        [("CALL", 110, 1), ("PUT", 90, 3), ("PUT", 80, 5), ("PUT", 70, 5)],
        [("CALL", 110, 1), ("CALL", None, 2), ("PUT", 90, 3), ("PUT", 80, 5)],
        [("CALL", 110, 1), ("CALL", 120, None), ("PUT", 90, 3), ("PUT", 80, 5)],
        [("CALL", 110, 1), ("CALL", 110, 7), ("PUT", 90, 3), ("PUT", 80, 5)],
        FOUR[:2],
        [],
    ],
)
def test_no_condor_without_two_strikes_a_side(spark, form, quotes):
    frame = form(silver(spark, chain(quotes)))
    assert frame.columns == list(CONDOR_COLUMNS)
    assert frame.collect() == []


@BOTH_FORMS
@pytest.mark.parametrize(
    "key", [(None, KEY[1], KEY[2]), ("SPY", None, KEY[2]), ("SPY", KEY[1], None)]
)
def test_no_condor_with_a_missing_key_part(spark, form, key):
    assert form(silver(spark, chain(FOUR, key))).collect() == []
    assert chains.valid_chains(silver(spark, chain(FOUR, key))).collect() == []


@BOTH_FORMS
def test_unknown_strikes_and_prices_do_not_disturb_a_valid_chain(spark, form):
    noise = [("CALL", None, 50), ("PUT", None, 50), ("CALL", 500, None), ("PUT", 1, None)]
    plain = form(silver(spark, chain(FOUR))).collect()
    assert form(silver(spark, chain([*FOUR, *noise]))).collect() == plain


def test_duplicate_strikes_are_averaged(spark):
    quotes = [*FOUR, ("CALL", 120, 4), ("CALL", 120, None)]
    legs = condor_legs(silver(spark, chain(quotes))).where("strike_price = 120").collect()
    assert [(leg.mid_price, leg.strike_rank) for leg in legs] == [(3.0, 1)]


def test_net_credit_ties_round_to_even(spark):
    quotes = [("CALL", 110, "0.125"), ("CALL", 120, "0.25"), ("PUT", 90, 0), ("PUT", 80, 0)]
    assert iron_condors(silver(spark, chain(quotes))).first().net_credit == 0.12


def test_valid_chains_count_distinct_strikes(spark):
    quotes = [*FOUR, ("CALL", 120, 9), ("CALL", 130, 1), ("PUT", None, 1)]
    row = chains.valid_chains(silver(spark, chain(quotes))).first()
    assert (row.num_calls, row.num_puts) == (3, 2)


def brute_force_condors(rows):
    mids = defaultdict(list)
    for underlying, traded, expiry, kind, strike, mid in rows:
        if None not in (underlying, traded, expiry, strike, mid):
            mids[underlying, traded, expiry, kind, strike].append(mid)
    sides = defaultdict(dict)
    for (*key, kind, strike), values in mids.items():
        sides[tuple(key)].setdefault(kind, {})[strike] = float(sum(values)) / len(values)
    found = set()
    for key, kinds in sides.items():
        calls, puts = kinds.get("CALL", {}), kinds.get("PUT", {})
        if len(calls) >= 2 and len(puts) >= 2:
            short_call, long_call = sorted(calls, reverse=True)[:2]
            short_put, long_put = sorted(puts)[:2]
            shorts = puts[short_put] + calls[short_call]
            longs = puts[long_put] + calls[long_call]
            found.add((
                *key, float(short_call), calls[short_call], float(long_call), calls[long_call],
                float(short_put), puts[short_put], float(long_put), puts[long_put],
                round((shorts - longs) * 100) / 100, "IRON_CONDOR",
            ))
    return found


@BOTH_FORMS
def test_condors_equal_brute_force_with_one_hot_chain(spark, form):
    """Random chains with gaps, ties and sub-cent prices; one chain holds a third of all rows."""
    random = Random(7)
    dates = [None, date(2025, 1, 1), date(2025, 1, 2)]
    keys = list(product(["SPY", "QQQ", None], dates, [None, date(2025, 2, 1), date(2025, 3, 1)]))

    def quote(key):
        strike = random.choice([None, *range(1, 9)])
        mid = random.choice([None, *(Decimal(n) / 200 for n in range(1, 50))])
        return chain([(random.choice(["CALL", "PUT"]), strike, mid)], key)[0]

    rows = [quote(random.choice(keys)) for _ in range(400)]
    rows += [quote(("SPY", dates[1], date(2025, 2, 1))) for _ in range(200)]
    condors = [tuple(row) for row in form(silver(spark, rows)).collect()]
    assert len(condors) == len(set(condors)) > 5
    assert set(condors) == brute_force_condors(rows)


def test_rows_of_valid_chains_equals_output_of_condors(spark):
    other = ("QQQ", KEY[1], KEY[2])
    frame = silver(spark, [*chain(FOUR), *chain(FOUR[:3], other)])
    kept = chains.rows_of_valid_chains(chains.strike_prices(frame)).select("underlying").distinct()
    assert [r.underlying for r in kept.collect()] == ["SPY"]
    assert [r.underlying for r in iron_condors(frame).collect()] == ["SPY"]


@pytest.fixture
def priced(spark):
    rows = [("A", *row) for row in chain([
        ("CALL", 100, "4.99"), ("CALL", 100, 5), ("PUT", 100, "4.99"), ("PUT", 100, 5),
        ("CALL", 100, None), (None, 100, 1),
    ])]
    return spark.createDataFrame(
        rows,
        "symbol string, underlying string, trade_date date, expiry_date date, option_type string, "
        "strike_price decimal(15,7), mid_price decimal(15,6)",
    )


def test_threshold_signals(priced):
    frame = threshold_signals(priced, "QQQ")
    assert frame.columns == list(THRESHOLD_COLUMNS)
    rows = frame.collect()
    assert [r.signal for r in rows] == ["BUY_CALL", "HOLD", "BUY_PUT", "HOLD", "HOLD", "HOLD"]
    assert {(r.underlying, r.strategy_name) for r in rows} == {("QQQ", "LAYMAN_SPY")}
    assert dict(frame.dtypes)["mid_price"] == "double"


def test_threshold_of_its_own_underlying_only(priced):
    assert threshold_signals(priced, "QQQ", only_underlying=True).count() == 0
    assert threshold_signals(priced, "SPY", only_underlying=True).count() == 6


def test_doubles_only_where_present(spark):
    frame = spark.createDataFrame([(Decimal("1.5"), "x")], "mid_price decimal(9,2), other string")
    assert chains.as_doubles(frame).dtypes == [("mid_price", "double"), ("other", "string")]


@pytest.mark.parametrize("anchor", [None, date(2025, 3, 31)])
def test_lookback_edges(spark, anchor):
    dates = ["2025-03-31", "2025-03-01", "2025-02-28"]
    rows = [row for d in dates for row in chain(FOUR[:1], ("SPY", day(d), day("2025-04-30")))]
    rows += chain(FOUR[:1], ("SPY", None, day("2025-04-30")))
    kept = lookback(silver(spark, rows), 30, anchor).select(F.col("trade_date").cast("string"))
    assert sorted(d for (d,) in kept.collect()) == ["2025-03-01", "2025-03-31"]


def test_lookback_of_nothing(spark):
    assert lookback(silver(spark, []), 30).count() == 0
