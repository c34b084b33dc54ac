"""Packing documents into token-budget batches of optimal length buckets."""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_TOKENS = 2048
BUCKETS = 8
STEP = 1
BUDGET = 65536
# Rows of one bucket that share these first hex digits of their hash are numbered together.
PREFIX_DIGITS = 3


def word_tokens() -> Column:
    """Tokens of a whole text where words at white space are the unit."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("long")


def pieces(docs: DataFrame, tokens: Column | None = None, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Rows (doc_id, piece, first_token, n_tokens): documents cut at ``max_tokens``, nothing dropped.

    A document without tokens has no piece, since there is nothing to train on.
    """
    n = tokens if tokens is not None else word_tokens()
    sized = docs.select("doc_id", n.alias("_n")).where("_n > 0")
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(max_tokens).cast("long")))
    cut = sized.select("doc_id", "_n", first.alias("first_token"))
    return cut.select(
        "doc_id",
        F.expr(f"first_token div {max_tokens}").alias("piece"),
        "first_token",
        F.least(F.lit(max_tokens).cast("long"), F.col("_n") - F.col("first_token")).alias("n_tokens"),
    )


def boundaries(
    histogram: dict[int, int], buckets: int = BUCKETS, step: int = STEP, top: int = MAX_TOKENS
) -> list[int]:
    """Bucket lengths that minimise padding over a histogram of lengths, by dynamic programming.

    Lengths are multiples of ``step``, the last one is ``top``, and at most ``buckets`` are
    chosen. Among equal costs the fewest, then the smallest lengths are taken. The table has one
    entry per multiple, however many documents were counted.
    """
    edges = [step * k for k in range(1, top // step + 1)]
    if edges[-1:] != [top]:
        edges.append(top)
    lengths = np.array([n for n in histogram], dtype=np.int64)
    counts = np.array([histogram[n] for n in histogram], dtype=np.int64)
    slot = np.searchsorted(edges, lengths) if len(lengths) else np.zeros(0, np.int64)
    held = np.cumsum(np.bincount(slot, counts, len(edges)).astype(np.int64))

    # Padded size is what varies: rows between two edges are stored at the upper one's length.
    size = np.array(edges, np.int64)
    none = np.iinfo(np.int64).max // 2
    # From start (row) to end (column); ``rank`` orders the paths of one level.
    added = np.where(np.tri(len(edges), dtype=bool), none, size * (held - held[:, None]))
    cost, rank, steps = size * held, np.arange(len(edges)), []
    chosen = (int(cost[-1]), 1)
    for level in range(2, min(buckets, len(edges)) + 1):
        options = np.minimum(cost[:, None] + added, none)
        cost = options.min(0)
        start = np.where(options == cost, rank[:, None], len(edges)).argmin(0)
        steps.append(start)
        order = np.lexsort((np.arange(len(edges)), rank[start]))
        rank = np.empty(len(edges), np.int64)
        rank[order] = np.arange(len(edges))
        if int(cost[-1]) < chosen[0]:
            chosen = (int(cost[-1]), level)
    path = [len(edges) - 1]
    for start in steps[: chosen[1] - 1][::-1]:
        path.append(int(start[path[-1]]))
    return [edges[k] for k in path[::-1]]


def packed(
    docs: DataFrame,
    tokens: Column | None = None,
    max_tokens: int = MAX_TOKENS,
    buckets: int = BUCKETS,
    step: int = STEP,
    budget: int = BUDGET,
) -> DataFrame:
    """Every piece of every document with its bucket, batch and place in the batch.

    The histogram of lengths, one row per length up to ``max_tokens``, is all the driver sees.
    Pieces of a bucket are put in the order of an MD5 hash of (doc_id, piece) and cut into batches
    of ``budget // bucket_tokens`` sequences; only a bucket's last batch may be short. Numbering
    is spread over hash prefixes and offset by their counts, so no task orders a whole bucket.

    Returns doc_id, piece, first_token, n_tokens, bucket_tokens, batch, slot. Empty and NULL texts
    have no row. A NULL doc_id packs like any other value. Repeated rows are packed each, in
    places next to each other. An empty table gives an empty result; other columns are ignored.
    """
    rows = pieces(docs, tokens, max_tokens)
    counted = rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()
    edges = boundaries({row.n_tokens: row.n for row in counted}, buckets, step, max_tokens)
    bucket = F.lit(None).cast("long")
    for edge in reversed(edges):
        bucket = F.when(F.col("n_tokens") <= edge, F.lit(edge).cast("long")).otherwise(bucket)
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "piece"))
    placed = rows.withColumns({"bucket_tokens": bucket, "_key": key})
    placed = placed.withColumn("_slice", F.substring("_key", 1, PREFIX_DIGITS))

    slices = placed.groupBy("bucket_tokens", "_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("bucket_tokens").orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = slices.select(
        "bucket_tokens", "_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy("bucket_tokens", "_slice").orderBy("_key", "doc_id", "piece")
    numbered = placed.withColumn("_row", F.row_number().over(within) - 1)
    place = F.col("_offset") + F.col("_row")
    size = F.expr(f"greatest(1, {budget} div bucket_tokens)")
    joined = numbered.join(offsets, ["bucket_tokens", "_slice"])
    return joined.select(
        "doc_id",
        "piece",
        "first_token",
        "n_tokens",
        "bucket_tokens",
        F.floor(place / size).cast("long").alias("batch"),
        (place % size).cast("long").alias("slot"),
    )
