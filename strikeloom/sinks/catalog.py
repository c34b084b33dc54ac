"""Catalog helpers shared by the table writers."""

from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import SparkSession

# Fixed value: how the catalog names the partition of NULL keys.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Fixed value: the option under which an overwrite replaces only the partitions it writes to.
OVERWRITE_OPTION = ("partitionOverwriteMode", "dynamic")
# Partitions named in one statement.
SPECS_PER_STATEMENT = 500


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


# Partitions of so many first keys are asked for one by one; for more of them all are listed.
ASKED_ONE_BY_ONE = 20


def partition_keys(
    spark: SparkSession, table: str, column: str = "", values: Iterable[str | None] = ()
) -> list[tuple[str | None, ...]]:
    """Values of the partition columns of every partition, None for NULL.

    ``column``, the first partition column, narrows them to those of its ``values``. Read from the
    catalog: one short string per partition, no data files.
    """
    wanted = set(values)

    def key(partition: str) -> tuple[str | None, ...]:
        texts = [unquote(part.split("=", 1)[1]) for part in partition.split("/")]
        return tuple(None if text == NULL_PARTITION else text for text in texts)

    def listed(condition: str = "") -> list[tuple[str | None, ...]]:
        return [key(row.partition) for row in spark.sql(f"SHOW PARTITIONS {table}{condition}").collect()]

    if not column:
        return listed()
    if None in wanted or len(wanted) > ASKED_ONE_BY_ONE:
        return [each for each in listed() if each[0] in wanted]
    return [each for value in wanted for each in listed(f" PARTITION ({column} = {sql_literal(value)})")]


def partition_values(spark: SparkSession, table: str) -> list[str]:
    """Distinct values of the first partition column; the NULL one is left out."""
    return list(dict.fromkeys(key[0] for key in partition_keys(spark, table) if key[0] is not None))


def sql_literal(value: str | None) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def drop_partitions(
    spark: SparkSession,
    table: str,
    columns: tuple[str, ...],
    keys: Iterable[tuple[str | None, ...]],
) -> None:
    """Drop the partitions of ``keys`` that exist, many in one statement."""
    specs = [
        f"PARTITION ({', '.join(f'{name} = {sql_literal(v)}' for name, v in zip(columns, key))})"
        for key in keys
    ]
    for start in range(0, len(specs), SPECS_PER_STATEMENT):
        dropped = ", ".join(specs[start : start + SPECS_PER_STATEMENT])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {dropped}")


def replace_written_partitions_only(spark: SparkSession, table: str) -> None:
    """Make overwrites of ``table`` replace only the partitions they write to.

    Kept with the table, not in the session, which other threads share.
    """
    name, value = OVERWRITE_OPTION
    described = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Storage Properties'")
    properties = described.first()
    if properties is None or f"{name}={value}" not in properties["data_type"]:
        spark.sql(f"ALTER TABLE {table} SET SERDEPROPERTIES ('{name}' = '{value}')")


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def set_table_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    pairs = ", ".join(f"{sql_literal(key)} = {sql_literal(value)}" for key, value in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")
