"""Data that a job writes for itself and reads again, in storage that every executor reaches."""

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return f"{base.rstrip('/')}/strikeloom/{uuid4().hex}"


def stored(frame: DataFrame) -> DataFrame:
    """Write ``frame`` as Parquet to shared storage and read it back.

    Cuts the lineage: what follows reads files, so a lost executor costs no recomputation, and a
    result that is used twice is computed once.
    """
    folder = shared_folder(frame.sparkSession)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)
