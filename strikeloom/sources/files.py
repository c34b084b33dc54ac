"""Quote files and tables as DataFrames."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strikeloom.schema import QUOTE_SCHEMA, REJECTED

# Quotes with one more column: the text of a line in which a field cannot be read or is missing.
SCAN_SCHEMA = T.StructType([*QUOTE_SCHEMA, T.StructField(REJECTED, T.StringType())])


def _with_file_name(quotes: DataFrame) -> DataFrame:
    """Add the last part of the file's URI, in which special characters stay percent-encoded."""
    return quotes.select("*", F.col("_metadata.file_name").alias("file_name"))


def read_quote_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Quote CSV files with a header, plus the name of the file each row came from.

    The schema is declared, so planning reads no data, and header names are checked against it.
    Fields that cannot be read or are missing are NULL; ``scan_quote_csv`` tells such lines apart.
    """
    reader = spark.read.schema(QUOTE_SCHEMA).option("header", True).option("enforceSchema", False)
    return _with_file_name(reader.csv(path))


def scan_quote_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The same for loads, with the text of unreadable lines in the column ``REJECTED``.

    Whether a line can be read depends on the columns asked for, so ask for all of them.
    """
    reader = spark.read.schema(SCAN_SCHEMA).option("header", True).option("enforceSchema", False)
    return _with_file_name(reader.option("columnNameOfCorruptRecord", REJECTED).csv(path))


def read_quote_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet quotes that share one schema; files without a ``file_name`` column get it added."""
    paths = [path] if isinstance(path, str) else path
    quotes = spark.read.option("mergeSchema", False).parquet(*paths)
    return quotes if "file_name" in quotes.columns else _with_file_name(quotes)


def stream_quote_csv(
    spark: SparkSession, path: str, files_per_batch: int, archive: str | None = None
) -> DataFrame:
    """``scan_quote_csv`` in micro-batches; ``archive`` receives files once processed."""
    reader = (
        spark.readStream.schema(SCAN_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", REJECTED)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _with_file_name(reader.csv(path))


READERS = {"csv": scan_quote_csv, "parquet": read_quote_parquet}
