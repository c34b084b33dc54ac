"""Row counts and digests of both layers per file, kept as a table and refreshed with each load."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strikeloom.operators.digests import DIGEST, differences, digests, merged
from strikeloom.schema import SOURCE, STATISTICS
from strikeloom.sinks.catalog import drop_partitions, partition_keys
from strikeloom.sinks.journal import FileKey
from strikeloom.sinks.layers import BY_DATE, bronze_table, files_of, on_partition, silver_table
from strikeloom.sinks.partitioned import replace_partitions, replace_table

LAYERS = {"bronze": bronze_table, "silver": silver_table}
KEY = ("layer", "trade_date", SOURCE)


def statistics_table(database: str) -> str:
    return f"{database}.{STATISTICS}"


def are_kept(spark: SparkSession, database: str) -> bool:
    return spark.catalog.tableExists(statistics_table(database))


def _counted(spark: SparkSession, database: str, files: set[FileKey] | None) -> DataFrame:
    parts = []
    for layer, name in LAYERS.items():
        rows = spark.table(name(database))
        rows = rows if files is None else files_of(rows, files)
        parts.append(digests(rows, "trade_date", SOURCE).select(F.lit(layer).alias("layer"), SOURCE, *DIGEST, "trade_date"))
    return parts[0].unionByName(parts[1])


def keep(spark: SparkSession, database: str) -> None:
    """Count everything once; from then on every load keeps the table up to date."""
    # A date has a few rows per file, so one task writes it.
    rows = _counted(spark, database, None).hint("rebalance", "trade_date")
    replace_table(rows, statistics_table(database), BY_DATE)


def refresh(spark: SparkSession, database: str, files: set[FileKey]) -> None:
    """Count ``files`` anew: only their rows are read, and only their dates' statistics written."""
    table, dates = statistics_table(database), {day for day, _ in files}
    if not files:
        return
    held = spark.table(table).where(on_partition("trade_date", dates))
    others = held.where(~F.col(SOURCE).isin([source for _, source in files]))
    counted = _counted(spark, database, files).unionByName(others)
    written = replace_partitions(counted.hint("rebalance", "trade_date"), table, BY_DATE)
    stored = partition_keys(spark, table, "trade_date", dates)
    drop_partitions(spark, table, BY_DATE, set(stored) - written)


def coverage(spark: SparkSession, database: str, layer: str = "silver") -> DataFrame:
    """Rows per trade date, newest first, from the kept counts alone."""
    rows = spark.table(statistics_table(database)).where(F.col("layer") == layer)
    return rows.groupBy("trade_date").agg(F.sum("row_count").alias("row_count")).orderBy(F.desc("trade_date"))


def layer_digests(spark: SparkSession, database: str) -> DataFrame:
    """Kept digests of each layer per trade date."""
    return merged(spark.table(statistics_table(database)), "layer", "trade_date")


def fresh_digests(spark: SparkSession, database: str) -> DataFrame:
    """The same, computed from the layers' rows."""
    return merged(_counted(spark, database, None), "layer", "trade_date")


def unreconciled(spark: SparkSession, database: str) -> DataFrame:
    """Files whose rows in silver are not those in bronze, by the kept digests.

    Policies that leave rows out show up here too.
    """
    kept = spark.table(statistics_table(database))
    sides = [kept.where(F.col("layer") == layer) for layer in LAYERS]
    found = differences(*sides, "trade_date", SOURCE)
    return found.withColumnsRenamed({"left_count": "bronze_count", "right_count": "silver_count"})


def changed_since(spark: SparkSession, database: str) -> DataFrame:
    """Layers and dates whose stored rows are no longer those that were counted when loaded."""
    found = differences(layer_digests(spark, database), fresh_digests(spark, database), "layer", "trade_date")
    return found.withColumnsRenamed({"left_count": "kept_count", "right_count": "stored_count"})
