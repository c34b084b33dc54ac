"""Numeric vectors as whole integers, for operators that compute on embeddings."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def integer_vectors(
    frame: DataFrame, keep: tuple[str, ...], column: str, scale: int, largest: int
) -> DataFrame:
    """Columns ``keep`` and ``x``: each component as ``floor(scale * component)``, an array of longs.

    Vectors that are NULL or hold NULL or non-finite components are left out. What lies beyond
    ``largest`` in size is taken as that bound, so that sums of squares stay in a long.
    """
    doubles = F.col(column).cast("array<double>")
    usable = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    bound = F.lit(float(largest))
    whole = F.transform(
        "_v", lambda c: F.floor(F.greatest(-bound, F.least(bound, c * F.lit(float(scale))))).cast("long")
    )
    rows = frame.select(*keep, doubles.alias("_v")).where(F.col("_v").isNotNull() & usable)
    return rows.select(*keep, whole.alias("x"))


def common_width(rows: DataFrame) -> int:
    """The length most vectors have, the smaller one of equally many; 0 without vectors."""
    sizes = rows.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.orderBy(F.desc("n"), "width").first()
    return found.width if found else 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of one batch as the rows of an array."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def batch_of(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    """Arrays as a batch of the given types."""
    arrays = [pa.array(columns[field.name], field.type) for field in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
