"""Writes whose tasks have a bounded number of rows, however few bytes they are read from."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import csv_line, write_csv
from strikeloom import jobs
from strikeloom.checks.landing import land_quotes
from strikeloom.checks.scratch import scratch_database, scratch_folder
from strikeloom.schema import QUOTE_SCHEMA
from strikeloom.sinks import clustering, dealing
from strikeloom.sinks.layers import bronze_table, silver_table

SYMBOLS = [f"SPX   250221C{strike * 1000:08d}" for strike in range(1000, 1060)]


@pytest.fixture
def few_rows(monkeypatch):
    monkeypatch.setattr(dealing, "ROWS_PER_TASK", 20)


@pytest.fixture
def landing(tmp_path):
    for stamp, number in (("20250127", 60), ("20250128", 3), ("20250129", 4), ("undated", 5)):
        write_csv(tmp_path / "landing", f"{stamp}.csv", [csv_line(s) for s in SYMBOLS[:number]])
    return str(tmp_path / "landing")


def per_file(frame):
    return [n for (n,) in frame.groupBy(F.input_file_name()).count().select("count").collect()]


def per_key(frame, *by):
    return Counter({tuple(row)[:-1]: row[-1] for row in frame.groupBy(*by).count().collect()})


def test_large_keys_are_split_and_small_ones_stay_together(spark):
    key = F.when(F.col("id") >= 100, (F.col("id") % 9).cast("string")).when(F.col("id") >= 10, "hot")
    rows = spark.range(190).select(key.alias("k"), "id")
    found = dealing.dealt(rows, rows, "k", most=30)
    assert sorted(found.select("id").toPandas()["id"]) == list(range(190))
    tasks = found.withColumn("task", F.spark_partition_id())
    sizes = per_key(tasks, "task").values()
    assert len(sizes) >= 7 and max(sizes) < 60
    spread = {k: n for k, n in tasks.groupBy("k").agg(F.count_distinct("task")).collect()}
    assert spread.pop("hot") == 3
    assert set(spread.values()) == {1} and None in spread
    assert dealing.dealt(rows, rows, "k", most=190) is None


def test_rows_that_were_not_counted_are_kept(spark):
    rows = spark.range(100).select((F.col("id") % 5).cast("string").alias("k"), "id")
    assert dealing.dealt(rows, rows.where("k < '3'"), "k", most=10).count() == 100


@pytest.mark.parametrize("regroup", [False, True])
def test_large_files_are_enriched_by_several_tasks(spark, landing, few_rows, regroup):
    database = scratch_database(spark)
    jobs.load(spark, landing, database, bootstrap=True, regroup=regroup)
    jobs.load(spark, landing, database, regroup=regroup)
    silver, bronze = spark.table(silver_table(database)), spark.table(bronze_table(database))
    assert per_key(silver, "trade_date", "symbol") == per_key(bronze, "trade_date", "symbol")
    assert silver.count() == 72
    # One task and file of 60 rows before.
    assert max(per_file(silver)) < 40


def test_large_parquet_is_loaded_by_several_tasks(spark, landing, few_rows, tmp_path):
    named = spark.read.schema(QUOTE_SCHEMA).option("header", True).csv(landing)
    named = named.withColumn("file_name", F.lit("x.20250127.csv"))
    named.coalesce(1).write.parquet(f"{tmp_path}/parquet")
    database = scratch_database(spark)
    jobs.load(spark, f"{tmp_path}/parquet", database, bootstrap=True, raw_format="parquet")
    bronze = spark.table(bronze_table(database))
    assert per_key(bronze, "symbol") == per_key(named, "symbol")
    assert max(per_file(bronze)) < 40


def test_large_dates_land_in_several_files(spark, landing, few_rows):
    quotes = spark.read.schema(QUOTE_SCHEMA).option("header", True).csv(landing)
    quotes = quotes.withColumn("file_name", F.element_at(F.split(F.input_file_name(), "/"), -1))
    landed = spark.read.schema(QUOTE_SCHEMA).option("header", True).csv(
        land_quotes(quotes, scratch_folder(spark))
    )
    assert per_key(landed, "symbol") == per_key(quotes, "symbol")
    assert max(per_file(landed)) < 40


def test_many_clustered_files_come_from_fewer_tasks(spark, monkeypatch):
    monkeypatch.setattr(clustering, "STREAMED_TASKS", 4)
    rows = spark.range(2000).select(
        F.lit("SPY").alias("underlying"),
        F.lit("2025-02-21").cast("date").alias("expiry_date"),
        (F.col("id") * 7 % 2000).alias("strike_price"),
        F.timestamp_seconds("id").alias("ts_recv"),
    )
    table = f"{scratch_database(spark)}.clustered"
    clustering.store_clustered(rows, table, 20)
    stored = spark.table(table)
    assert stored.exceptAll(rows).isEmpty() and rows.exceptAll(stored).isEmpty()
    files = stored.groupBy(F.input_file_name().alias("file")).agg(
        F.min("strike_price").alias("low"), F.max("strike_price").alias("high")
    )
    ranges = sorted((row.low, row.high) for row in files.collect())
    assert 16 <= len(ranges) <= 20
    # Each file covers a range of its own.
    assert all(high <= low + 2 for (_, high), (low, _) in zip(ranges, ranges[1:]))
    tasks = {name.rsplit("part-", 1)[1][:5] for (name,) in files.select("file").collect()}
    assert len(tasks) <= 4
