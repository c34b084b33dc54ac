"""Physical plans have the shape the design counts on."""

import re

import pytest
from pyspark.sql import functions as F

from strikeloom import jobs
from strikeloom.checks.lineitem_quotes import quotes_from_lineitem
from strikeloom.checks.queries import landed
from strikeloom.checks.scratch import scratch_database
from strikeloom.operators import chains, reports
from strikeloom.operators.enrich import enrich
from strikeloom.operators.lookback import lookback, newest_stored_date
from strikeloom.operators.policies import liquidity
from strikeloom.plans.condor import iron_condors
from strikeloom.plans.threshold import threshold_signals
from strikeloom.sinks.layers import SILVER_KEY, SILVER_ORDER, bronze_table, files_of, silver_table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark):
    database = scratch_database(spark)
    jobs.load(spark, landed(spark, SF_DIR), database, bootstrap=True)
    return database


@pytest.fixture(scope="module")
def silver(spark, stored):
    return spark.table(silver_table(stored))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*?)>", text)[1]))


def test_condor_shuffles_aggregated_rows_only(silver):
    text = plan(iron_condors(silver))
    assert "Python" not in text and "Pandas" not in text
    assert "Join" not in text and "Expand" not in text
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange hashpartitioning") == 3
    # Each shuffle is fed by a partial step: two partial aggregates and a partial rank limit.
    feeding = re.findall(r"Exchange hashpartitioning.*\n[\s+\-:]*(?:\*\(\d+\) )?(\w+)", text)
    assert feeding == ["HashAggregate", "WindowGroupLimit", "HashAggregate"]
    assert read_columns(text) == {
        "underlying", "expiry_date", "option_type", "strike_price", "mid_price",
    }


def test_threshold_is_a_pruned_scan_without_shuffle(spark, stored, silver):
    anchor = newest_stored_date(spark, silver_table(stored))
    text = plan(threshold_signals(lookback(silver, 3, anchor)))
    assert "Exchange" not in text and "Python" not in text
    assert re.search(r"PartitionFilters: \[.*trade_date.* >= ", text)
    assert "underlying" not in read_columns(text)


def test_lookback_without_anchor_prunes_by_subquery(silver):
    text = plan(lookback(silver, 3))
    assert re.search(r"PartitionFilters: \[.*>= .*[Ss]ubquery", text)
    assert "Join" not in text


def test_enrichment_is_one_projection(spark):
    text = plan(enrich(quotes_from_lineitem(spark, SF_DIR)))
    assert "Exchange" not in text and "Python" not in text and "Join" not in text


def test_refreshed_files_prune_bronze_by_plain_conditions(spark, stored):
    files = {("2025-01-03", "a@0"), ("2025-01-04", "b@0")}
    text = plan(enrich(files_of(spark.table(bronze_table(stored)), files)))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text)[1]
    assert re.search(r"trade_date#\d+ IN \(2025-01-0\d,2025-01-0\d\)", filters)
    assert re.search(r"source#\d+ IN \(", filters)
    assert "regexp" not in text and "substr(file_name" not in text
    assert "Join" not in text


def test_liquidity_reaches_the_scan(silver):
    text = plan(liquidity(silver))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(bid_px_00,0.0\)", text)


def test_reports_combine_before_shuffling(silver):
    text = plan(reports.latest_dates(silver))
    assert "TakeOrderedAndProject" in text
    text = plan(chains.valid_chains(silver))
    assert "Expand" not in text and text.count("Exchange hashpartitioning") == 2
    assert plan(reports.date_coverage(silver)).count("Exchange hashpartitioning") == 1


def test_loads_do_not_shuffle_and_sort_once(spark, stored, silver):
    bronze = spark.table(bronze_table(stored))
    rows = enrich(bronze).withColumn("part", F.col("source"))
    rows = rows.sortWithinPartitions(*SILVER_KEY, *SILVER_ORDER).select(*silver.columns)
    insert = f"EXPLAIN INSERT OVERWRITE TABLE {silver_table(stored)} SELECT * FROM {{rows}}"
    text = spark.sql(insert, rows=rows).first()[0]
    assert "Exchange" not in text
    assert len(re.findall(r"\bSort \[", text)) == 1
