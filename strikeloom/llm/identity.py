"""What tells rows of a document table apart, and names that clash with no column of theirs."""

from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh_name(base: str) -> str:
    """A column name that no caller's table has."""
    return f"_{base}_{uuid4().hex}"


def row_identity() -> Column:
    """Struct of a row's ``doc_id`` and its text's hash, ordered by id with NULL ids last.

    Rows without an id and different texts under one id differ in it; only rows that repeat both
    share it. It is made from the row alone, so it is the same after a task is run again.
    """
    return F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64("text").alias("text_hash")
    )


def without_rows(docs: DataFrame, identities: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``row_identity`` is listed in column ``row`` of ``identities``.

    Ids are compared null-safe beside the hash, so rows without an id spread over all tasks.
    """
    number, digest = fresh_name("doc_id"), fresh_name("text_hash")
    listed = identities.select(
        F.col("row.doc_id").alias(number), F.col("row.text_hash").alias(digest)
    ).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(number)) & (F.xxhash64("text") == F.col(digest))
    return docs.join(listed, same, "left_anti")
