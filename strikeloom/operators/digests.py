"""Digests of row multisets: independent of order, sensitive to every row and how often it occurs.

A row's text is hashed once; the hash's two halves are counted, combined by exclusive or, and added
up. All four merge by the same operations, so digests of files add up to those of dates and layers.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strikeloom.schema import QUOTE_SCHEMA

# Stand between values and for NULL in a row's text.
BETWEEN, MISSING = "\x1f", "\x1e"
DIGEST = ("row_count", "hash_xor", "hash_sum", "other_sum")


def _text(field: T.StructField) -> Column:
    """A value as text that any engine writes alike: instants in microseconds, six decimals."""
    value = F.col(field.name)
    if isinstance(field.dataType, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(field.dataType, T.DoubleType):
        value = value.try_cast("decimal(20,6)")
    return F.coalesce(value.cast("string"), F.lit(MISSING))


def _half(digest: Column, start: int) -> Column:
    """Sixty bits of a hexadecimal hash as a long."""
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("bigint")


def digests(rows: DataFrame, *by: str, fields: T.StructType = QUOTE_SCHEMA) -> DataFrame:
    """Digest of the rows' ``fields`` per group; tasks combine before the one shuffle."""
    text = F.concat_ws(BETWEEN, *[_text(field) for field in fields])
    hashed = rows.select(*by, F.md5(text).alias("_md5"))
    halves = hashed.select(*by, _half(F.col("_md5"), 1).alias("_h"), _half(F.col("_md5"), 16).alias("_g"))
    return halves.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.bit_xor("_h").alias("hash_xor"),
        F.sum(F.col("_h").cast("decimal(38,0)")).alias("hash_sum"),
        F.sum(F.col("_g").cast("decimal(38,0)")).alias("other_sum"),
    )


def merged(parts: DataFrame, *by: str) -> DataFrame:
    """Digests of larger groups from those of smaller ones."""
    return parts.groupBy(*by).agg(
        F.sum("row_count").alias("row_count"),
        F.bit_xor("hash_xor").alias("hash_xor"),
        F.sum("hash_sum").cast("decimal(38,0)").alias("hash_sum"),
        F.sum("other_sum").cast("decimal(38,0)").alias("other_sum"),
    )


def differences(left: DataFrame, right: DataFrame, *by: str) -> DataFrame:
    """Groups whose digests differ or that one side lacks, with both row counts."""
    a = left.select(*by, F.struct(*DIGEST).alias("_a"))
    b = right.select(*by, F.struct(*DIGEST).alias("_b"))
    on = [F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}")) for name in by]
    both = a.alias("l").join(b.alias("r"), on, "full")
    keys = [F.coalesce(f"l.{name}", f"r.{name}").alias(name) for name in by]
    counts = F.col("_a.row_count").alias("left_count"), F.col("_b.row_count").alias("right_count")
    return both.where(~F.col("_a").eqNullSafe(F.col("_b"))).select(*keys, *counts)
