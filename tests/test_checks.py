"""Check queries beside what else a session or a large input holds."""

import pytest
from pyspark.sql import functions as F

from strikeloom.checks.queries import QUERIES


@pytest.fixture
def sf_dir(spark, tmp_path):
    """A folder with a small ``lineitem``: 800 rows over all trade dates."""
    number = F.col("id")
    rows = spark.range(800).select(
        (number % 80).alias("l_orderkey"),
        (number % 200).alias("l_partkey"),
        (number % 10).alias("l_suppkey"),
        (number % 7 + 1).cast("int").alias("l_linenumber"),
        (number % 50 + 1).cast("double").alias("l_quantity"),
        (number % 11 / 100).alias("l_discount"),
        (number % 9 / 100).alias("l_tax"),
    )
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_kept_table_is_listed_beside_temporary_views(spark, sf_dir):
    spark.range(1).createOrReplaceTempView("some_view")
    try:
        assert QUERIES["ddl_roundtrip"](spark, sf_dir).count() == 40
    finally:
        spark.catalog.dropTempView("some_view")
