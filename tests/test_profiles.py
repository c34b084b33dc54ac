"""Sketched profiles: merging, refreshing by date, and columns without values."""

from uuid import uuid4

import pytest
from helpers import csv_line, write_csv
from pyspark.sql import functions as F

from strikeloom import jobs
from strikeloom.operators.profiles import distinct_count, merged, most_frequent, quantile, sketched
from strikeloom.sinks import profiles
from strikeloom.sinks.catalog import create_database


def test_merged_groups_equal_one_pass_within_the_error(spark):
    rows = spark.range(100_000, numPartitions=8).select(
        (F.col("id") % 7).alias("day"),
        F.when(F.col("id") % 10 != 0, F.col("id").cast("double")).alias("price"),
        F.lit(None).cast("double").alias("unknown"),
        F.when(F.col("id") % 3 == 0, "often").otherwise(F.concat(F.lit("k"), F.col("id") % 5_000)).alias("name"),
    )
    parts = sketched(rows, ["price", "unknown"], ["name"], "day")
    assert parts.count() == 7
    one = merged(parts, ["price", "unknown"], ["name"]).select(
        "row_count", "price_count", "price_min", "price_max", "unknown_count", "unknown_min",
        quantile("price", 0.5).alias("middle"), quantile("unknown", 0.5).alias("none"),
        distinct_count("name").alias("names"), most_frequent("name", 1).alias("top"),
    ).first()
    assert (one.row_count, one.price_count, one.price_min, one.price_max) == (100_000, 90_000, 1.0, 99_999.0)
    assert (one.unknown_count, one.unknown_min, one.none) == (0, None, None)
    assert abs(one.middle - 50_000) < 2_000
    assert abs(one.names - 5_001) < 5_001 * 0.08
    assert one.top[0]["item"] == "often" and abs(one.top[0]["count"] - 33_334) < 1_000


def test_profile_of_no_rows(spark):
    rows = spark.createDataFrame([], "day int, price double, name string")
    parts = sketched(rows, ["price"], ["name"], "day")
    assert parts.count() == 0
    assert merged(parts, ["price"], ["name"]).count() == 0
    assert merged(parts, ["price"], ["name"]).first() is None


@pytest.fixture
def database(spark, tmp_path):
    name = f"profiles_{uuid4().hex}"
    create_database(spark, name, str(tmp_path / "db"))
    return name


def test_only_named_dates_are_profiled_anew(spark, tmp_path, database):
    symbol = "SPXW  250128C05000000"
    paths = [
        write_csv(tmp_path / "in", f"opra-pillar-202501{day}.cbbo-1m.csv", [csv_line(symbol, bid=str(day))] * 3)
        for day in (28, 29)
    ]
    jobs.load(spark, paths, database, bootstrap=True)
    profiles.keep_profile(spark, database)
    write_csv(tmp_path / "in", "opra-pillar-20250129.cbbo-1m.csv", [csv_line(symbol, bid="2", ask="9")] * 5)
    jobs.load(spark, paths[1], database)
    before = profiles.profile(spark, database).first()
    profiles.keep_profile(spark, database, ["2025-01-29", "2025-01-31"])
    after = profiles.profile(spark, database).first()
    late = profiles.profile(spark, database, first="2025-01-29").first()
    assert (before.row_count, before.bid_px_00_min, after.row_count, after.bid_px_00_min) == (6, 28.0, 8, 2.0)
    assert (late.row_count, late.ask_px_00_max) == (5, 9.0)
    assert profiles.profile(spark, database, last="2025-01-01").first() is None
