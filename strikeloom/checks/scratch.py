"""Scratch space for tables that checks write and read back."""

from uuid import uuid4

from pyspark.sql import SparkSession

from strikeloom.sinks.catalog import create_database
from strikeloom.sinks.shared import shared_folder


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder in storage that every executor reaches; also on one machine."""
    return shared_folder(spark)


def scratch_database(spark: SparkSession) -> str:
    """A fresh database with its tables in scratch space."""
    name = f"strikeloom_{uuid4().hex}"
    create_database(spark, name, f"{scratch_folder(spark)}/{name}")
    return name
