"""Slices along the curve: same rows, and less read than with rows sorted by one column after another."""

from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from strikeloom.sinks.catalog import create_database
from strikeloom.sinks.clustering import clustered_slice, curve_key, store_clustered

SMALL_GROUPS = {"parquet.block.size": "16384", "parquet.page.size": "4096"}


@pytest.fixture
def database(spark, tmp_path):
    name = f"clustered_{uuid4().hex}"
    create_database(spark, name, str(tmp_path / "db"))
    return name


def contracts(spark, n=60_000):
    mixed = F.pmod(F.xxhash64("id"), F.lit(1_000_003))
    return spark.range(n, numPartitions=4).select(
        F.concat(F.lit("U"), mixed % 8).alias("underlying"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.floor(mixed / 8) % 60).cast("int")).alias("expiry_date"),
        (F.floor(mixed / 480) % 200).cast("decimal(15,7)").alias("strike_price"),
        F.timestamp_seconds(F.col("id")).alias("ts_recv"),
        F.col("id"),
    )


def rows_read(frame):
    """Result and the rows that its scan handed on, which are those of the row groups it opened."""
    result = frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return result, leaves.head().metrics().apply("numOutputRows").value()


def test_filters_on_each_column_read_less(spark, database):
    rows = contracts(spark)
    store_clustered(rows, f"{database}.curve", 8, **SMALL_GROUPS)
    by_column = rows.repartitionByRange(8, "underlying", "expiry_date", "strike_price").sortWithinPartitions(
        "underlying", "expiry_date", "strike_price"
    )
    by_column.write.options(**SMALL_GROUPS).saveAsTable(f"{database}.sorted")
    assert spark.table(f"{database}.curve").count() == rows.count()
    total = {"curve": 0, "sorted": 0}
    for condition in ("strike_price < 12", "strike_price BETWEEN 100 AND 104 AND expiry_date < DATE'2025-01-09'", "expiry_date = DATE'2025-02-10'"):
        found = {}
        for name in total:
            result, read = rows_read(spark.table(f"{database}.{name}").where(condition).select("id", "strike_price", "expiry_date"))
            found[name], total[name] = sorted(row.id for row in result), total[name] + read
        assert found["curve"] == found["sorted"] == sorted(r.id for r in rows.where(condition).collect())
    assert total["curve"] < total["sorted"] / 2, total


def test_one_contract_with_most_rows_spreads(spark, database):
    hot = contracts(spark, 20_000).withColumn("underlying", F.lit("U")).withColumn("strike_price", F.lit(5).cast("decimal(15,7)"))
    hot = hot.withColumn("expiry_date", F.lit("2025-01-01").cast("date"))
    store_clustered(hot, f"{database}.hot", 5)
    sizes = spark.table(f"{database}.hot").groupBy(F.input_file_name()).count().collect()
    assert len(sizes) == 5 and max(row["count"] for row in sizes) < 8_000


def test_odd_values_are_kept(spark, database):
    rows = spark.createDataFrame(
        [(None, None, None, 1), ("A", float("nan"), None, 2), ("A", 1.0, 3, 3), ("B", -2.0, 9, 4)] * 2,
        "underlying string, price double, number int, ts_recv int",
    )
    store_clustered(rows, f"{database}.odd", 3, ("underlying", "price", "number"))
    assert sorted(map(repr, spark.table(f"{database}.odd").collect())) == sorted(map(repr, rows.collect()))
    store_clustered(rows.limit(0), f"{database}.none", 0, ("price", "number"))
    assert spark.table(f"{database}.none").count() == 0
    with pytest.raises(ValueError, match="room"):
        curve_key(rows, ())
    with pytest.raises(ValueError, match="cannot replace"):
        clustered_slice(spark, f"{database}.odd", f"{database}.ODD", "true")
