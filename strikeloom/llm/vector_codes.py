"""Vectors as one code per part, found through dictionaries of the values of each dimension.

A part's distance to a codebook entry is a sum over its dimensions, and a dimension has few distinct
integers. So the squared differences of every distinct integer to all entries are tabulated once,
and distances are rows of those tables, gathered by dictionary code and added.
"""

from collections.abc import Iterator
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikeloom.llm.vectors import batch_of, common_width, integer_vectors, matrix
from strikeloom.sinks.shared import stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Components are taken to be at most this large: 64 squared differences then fit a long.
LARGEST = isqrt(2**63 // 64) // 2 - 1
# Vectors whose distances a task holds at a time: 1 MB for 64 entries.
ROWS_AT_ONCE = 2048

# Codebooks: for each part its entries, one row each.
Codebooks = list[np.ndarray]


def part_slices(width: int, parts: int = PARTS) -> list[slice]:
    """Consecutive parts, of equal length where ``parts`` divides the width."""
    edges = [width * p // parts for p in range(parts + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def dictionary(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct integers of one dimension, rising, and the code of every row."""
    low, high = int(values.min()), int(values.max())
    if high - low > 8 * len(values):
        return np.unique(values, return_inverse=True)
    shifted = values - low
    present = np.bincount(shifted) > 0
    codes = np.cumsum(present) - 1
    return np.flatnonzero(present) + low, codes[shifted]


def nearest(x: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest entry, the first of equally near ones, and its squared distance."""
    tables = []
    for d in range(x.shape[1]):
        values, codes = dictionary(x[:, d])
        tables.append(((values[:, None] - codebook[None, :, d]) ** 2, codes))
    entry, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for start in range(0, len(x), ROWS_AT_ONCE):
        rows = slice(start, start + ROWS_AT_ONCE)
        total = np.zeros((len(x[rows]), len(codebook)), np.int64)
        for table, codes in tables:
            total += table[codes[rows]]
        entry[rows] = total.argmin(1)
        distance[rows] = total.min(1)
    return entry, distance


def _batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, matrix(batch["x"], width)


def _moved(rows: DataFrame, codebooks: Codebooks, slices: list[slice], width: int) -> Codebooks:
    """Every entry moved to the floored mean of the parts nearest to it, or left where it has none.

    Tasks add up before the shuffle. What reaches the driver has a row per part, entry and
    dimension (-1 for the number of vectors), however many vectors there are.
    """
    schema = pa.schema([(name, pa.int64()) for name in ("part", "entry", "dimension", "total")])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = len(codebooks[0])
        counts = np.zeros((len(slices), entries), np.int64)
        sums = np.zeros((entries, width), np.int64)
        for _, x in _batches(batches, width):
            for p, own in enumerate(slices):
                entry, _ = nearest(x[:, own], codebooks[p])
                counts[p] += np.bincount(entry, minlength=entries)
                for d in range(own.start, own.stop):
                    sums[:, d] += np.bincount(entry, x[:, d], entries).astype(np.int64)
        for p, own in enumerate(slices):
            used = np.flatnonzero(counts[p])
            for d, totals in [(-1, counts[p]), *((d, sums[:, d]) for d in range(own.start, own.stop))]:
                same = np.full(len(used), p), used, np.full(len(used), d), totals[used]
                yield batch_of(dict(zip(schema.names, same)), schema)

    partial = rows.select("x").mapInArrow(summed, "part bigint, entry bigint, dimension bigint, total bigint")
    added = partial.groupBy("part", "entry", "dimension").agg(F.sum("total").alias("total")).collect()
    sizes = {(row.part, row.entry): row.total for row in added if row.dimension < 0}
    moved = [codebook.copy() for codebook in codebooks]
    for row in added:
        if row.dimension >= 0:
            place = row.dimension - slices[row.part].start
            moved[row.part][row.entry, place] = row.total // sizes[row.part, row.entry]
    return moved


def trained(rows: DataFrame, width: int, parts: int, entries: int, rounds: int, order: str) -> Codebooks:
    """Codebooks that start as the parts of the first vectors by ``order`` and move to their parts' means.

    Means are floored; an entry without vectors stays where it is.
    """
    slices = part_slices(width, parts)
    first = rows.orderBy(F.col(order).asc_nulls_last(), "x").limit(entries).select("x").collect()
    start = np.array([row.x for row in first], np.int64).reshape(len(first), width)
    codebooks = [start[:, own].copy() for own in slices]
    for _ in range(rounds if len(start) else 0):
        codebooks = _moved(rows, codebooks, slices, width)
    return codebooks


def digest(codebooks: Codebooks) -> str:
    """SHA-256 of all components by part, entry and place, in decimal and joined by commas."""
    listed = ",".join(str(c) for codebook in codebooks for c in codebook.ravel().tolist())
    return sha256(listed.encode()).hexdigest()


def decoded(codes: list[int], codebooks: Codebooks) -> list[int]:
    """The integer vector that a code stands for."""
    return [c for code, codebook in zip(codes, codebooks) for c in codebook[code].tolist()]


def compressed(
    frame: DataFrame,
    identity: str = "vec_id",
    column: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """Each usable vector's codes and error, and the codebooks that decode them.

    Rows hold ``identity``, ``label``, codes (an array of one entry number per part), error (the
    squared distance to what the codes stand for) and label_error (the sum of the errors of all
    rows of that label, NULL labels together). Codebooks start as the parts of the ``entries``
    vectors with the smallest ids, a NULL id last, rows of one id in the order of their
    components; ``rounds`` times all vectors are assigned and the entries moved to their means.

    All vectors are read in every round, each in the task that holds it: nothing but sums per
    entry is shuffled, so a vector that a third of all rows share is no hot key. Tables have an
    entry per distinct value of a batch. Errors are added per label before their shuffle.

    Vectors that are NULL or hold NULL or non-finite components, and those of another length than
    most have (the smaller of two lengths equally frequent), have no row. Components beyond
    ``LARGEST`` count as that bound. Where the length is no multiple of ``parts``, parts differ by
    one component, and an empty part has code 0. Repeated rows are coded each. An empty table
    gives an empty result and codebooks without entries; other columns are ignored.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code is one of 1 to 256 entries")
    named = frame.select(
        F.col(identity).alias("_id"), F.col(label).alias("_label"), F.col(column).alias("_vector")
    )
    rows = integer_vectors(named, ("_id", "_label"), "_vector", scale, LARGEST)
    width = common_width(rows)
    rows = stored(rows.where((F.size("x") == width) & (F.size("x") > 0)))
    slices = part_slices(width, parts)
    codebooks = trained(rows, width, parts, entries, rounds, "_id")

    kinds = dict(rows.dtypes)
    result = f"_id {kinds['_id']}, _label {kinds['_label']}, codes array<int>, error bigint"

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _batches(batches, width):
            codes, error = np.zeros((len(x), parts), np.int32), np.zeros(len(x), np.int64)
            for p, own in enumerate(slices):
                codes[:, p], distance = nearest(x[:, own], codebooks[p])
                error += distance
            offsets = np.arange(len(x) + 1, dtype=np.int32) * parts
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.ravel()))
            yield pa.record_batch(
                {"_id": batch["_id"], "_label": batch["_label"], "codes": listed, "error": pa.array(error)}
            )

    found = stored(rows.mapInArrow(coded, result))
    # Added as decimals: a label's errors may be more than a long holds.
    added = F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum")
    sums = found.groupBy(F.col("_label").alias("_of")).agg(added)
    joined = found.join(sums, F.col("_label").eqNullSafe(F.col("_of")))
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    return (
        joined.select(
            F.col("_id").alias(identity),
            F.col("_label").alias(label),
            "codes",
            "error",
            F.least("_sum", most).cast("long").alias("label_error"),
        ),
        codebooks,
    )
