"""Digests and kept statistics, the shared scan and cancelled strategies."""

import time
from threading import Thread

import pytest
from pyspark.sql import functions as F

from helpers import csv_line, write_csv
from strikeloom import jobs
from strikeloom.checks.scratch import scratch_database
from strikeloom.operators.digests import differences, digests, merged
from strikeloom.plans.registry import STRATEGIES, Strategy
from strikeloom.schema import QUOTE_SCHEMA
from strikeloom.sinks import statistics
from strikeloom.sinks.layers import SILVER_KEY, gold_table, silver_table
from strikeloom.sinks.partitioned import replace_partitions
from strikeloom.sources.files import read_quote_csv
from test_tables import CHAIN, coverage, file_of


@pytest.fixture
def database(spark, tmp_path):
    for k, stamp in enumerate(("20250127", "20250128", "20250129")):
        write_csv(tmp_path / "landing", file_of(stamp), [csv_line(s, bid=str(1 + k)) for s in CHAIN])
    database = scratch_database(spark)
    jobs.load(spark, str(tmp_path / "landing"), database, bootstrap=True)
    statistics.keep(spark, database)
    return database


def test_digests_ignore_order_and_see_every_change(spark, tmp_path):
    lines = [csv_line(s, bid=str(k)) for k, s in enumerate(CHAIN * 20)]
    quotes = read_quote_csv(spark, write_csv(tmp_path, file_of("20250127"), lines))
    whole = digests(quotes, "file_name")
    assert differences(whole, digests(quotes.repartition(7), "file_name"), "file_name").isEmpty()
    halves = [quotes.where(F.col("bid_px_00") % 2 == k) for k in (0, 1)]
    parts = digests(halves[0], "file_name").unionByName(digests(halves[1], "file_name"))
    assert differences(whole, merged(parts, "file_name"), "file_name").isEmpty()
    changed = {
        "doubled": quotes.unionByName(quotes.limit(1)),
        "doubled twice": quotes.unionByName(quotes.limit(1)).unionByName(quotes.limit(1)),
        "lost": quotes.where("bid_px_00 <> 3"),
        "swapped": quotes.withColumns({"bid_px_00": F.col("ask_px_00"), "ask_px_00": F.col("bid_px_00")}),
        "one for another": quotes.where("bid_px_00 <> 3").unionByName(quotes.where("bid_px_00 = 4")),
        "null": quotes.withColumn("side", F.when(F.col("bid_px_00") != 3, F.col("side"))),
    }
    for name, rows in changed.items():
        found = differences(whole, digests(rows, "file_name"), "file_name").collect()
        assert [row.left_count for row in found] == [80], name


def test_text_that_runs_together_is_told_apart(spark):
    fields = "instrument_id string, side string"
    rows = [spark.createDataFrame([pair], fields) for pair in (("ab", "c"), ("a", "bc"), ("abc", None), ("abc", ""))]
    kinds = [f for f in QUOTE_SCHEMA if f.name in ("instrument_id", "side")]
    found = {digests(each, fields=kinds).first().hash_xor for each in rows}
    assert len(found) == 4


def test_statistics_follow_loads(spark, database, tmp_path):
    late = write_csv(tmp_path / "late", "late-20250128.csv", [csv_line(s) for s in CHAIN[:2]])
    for change in (
        lambda: jobs.load(spark, late, database),
        lambda: jobs.load(spark, write_csv(tmp_path / "late", "late-20250128.csv", []), database),
        lambda: jobs.load(spark, write_csv(tmp_path / "landing", file_of("20250129"), []), database),
        lambda: jobs.load(spark, str(tmp_path / "landing"), database, regroup=True),
        lambda: jobs.load(spark, write_csv(tmp_path / "odd", "undated.csv", [csv_line(CHAIN[0])]), database),
        lambda: jobs.load(spark, str(tmp_path / "landing"), database, bootstrap=True),
    ):
        change()
        kept = {row.trade_date and str(row.trade_date): row.row_count for row in statistics.coverage(spark, database).collect()}
        assert kept == coverage(spark, database)
        assert jobs.verify(spark, database)


def test_only_touched_dates_are_counted_again(spark, database, tmp_path):
    table = statistics.statistics_table(database)
    before = set(spark.table(table).inputFiles())
    jobs.load(spark, write_csv(tmp_path / "landing", file_of("20250128"), [csv_line(CHAIN[0])]), database)
    after = set(spark.table(table).inputFiles())
    assert {path.split("trade_date=")[1][:10] for path in before ^ after} == {"2025-01-28"}


def test_rows_changed_behind_the_loads_are_found(spark, database):
    silver = silver_table(database)
    day = spark.table(silver).where("trade_date = '2025-01-28'")
    replace_partitions(day.unionByName(day.limit(1)), silver, SILVER_KEY)
    spark.catalog.refreshTable(silver)
    found = statistics.changed_since(spark, database).collect()
    assert [(row.layer, str(row.trade_date), row.kept_count, row.stored_count) for row in found] == [
        ("silver", "2025-01-28", 4, 5)
    ]
    assert not jobs.verify(spark, database)


def test_filtered_rows_are_shown_as_unreconciled(spark, tmp_path):
    lines = [csv_line(CHAIN[0]), csv_line(CHAIN[1], bid="0.0")]
    path = write_csv(tmp_path / "in", file_of("20250127"), lines)
    database = scratch_database(spark)
    jobs.load(spark, path, database, bootstrap=True, policies=["liquidity"])
    statistics.keep(spark, database)
    found = statistics.unreconciled(spark, database).collect()
    assert [(row.bronze_count, row.silver_count) for row in found] == [(2, 1)]


def test_shared_scan_reads_silver_once(spark, database):
    strategies = list(STRATEGIES.values())
    anchor = spark.table(silver_table(database)).agg(F.max("trade_date")).first()[0]
    shared = jobs.shared_silver(spark, database, strategies, anchor)
    try:
        plans = [
            strategy.signals(jobs.lookback(shared, strategy.lookback_days, anchor).select(*strategy.columns))
            for strategy in strategies
        ]
        for frame in plans:
            text = frame._jdf.queryExecution().executedPlan().toString()
            assert "InMemoryTableScan" in text
        named = {column for strategy in strategies for column in strategy.columns}
        assert set(shared.columns) == named | {"trade_date"}
    finally:
        shared.unpersist()


def test_shared_scan_stores_what_single_scans_do(spark, database):
    def stored():
        return {name: sorted(map(str, spark.table(gold_table(database, name)).collect())) for name in STRATEGIES}

    assert all(jobs.run_strategies(spark, database, list(STRATEGIES)).values())
    apart = stored()
    assert all(jobs.run_strategies(spark, database, list(STRATEGIES), shared_scan=True).values())
    assert stored() == apart
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_a_cancelled_strategy_leaves_the_others(spark, database):
    def slow(silver):
        return silver.where(F.expr("reflect('java.lang.Thread', 'sleep', 30000L) IS NULL")).select("trade_date")

    registry = {**STRATEGIES, "Slow": Strategy(("trade_date",), slow, lookback_days=30)}
    outcome = {}
    run = Thread(
        target=lambda: outcome.update(jobs.run_strategies(spark, database, ["Slow", "LaymanSPYStrategy"], registry, True))
    )
    started = time.time()
    run.start()
    while run.is_alive() and time.time() - started < 25:
        if jobs.has_gold(spark, database, "LaymanSPYStrategy"):
            jobs.cancel_strategy(spark, database, "Slow")
        time.sleep(0.5)
    run.join()
    assert outcome == {"Slow": False, "LaymanSPYStrategy": True}
    assert time.time() - started < 28
