"""Connected components of a graph given by its links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikeloom.sinks.shared import stored


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``links`` (a, b); the root is the smallest node it reaches.

    Large-star and small-star steps alternate until nothing changes. Each minimum is combined on
    the map side before its shuffle, so a node with a third of all links reaches a reducer as one
    row per task, and the joins that hand minima back are left to adaptive skew handling. Every
    round is written to shared storage. Links to itself and repeated links are ignored.
    """
    edges = stored(_oriented(links.select("a", "b")))
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        roots.select(F.col("root").alias("node"), "root")
    )


def _oriented(links: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller end."""
    ends = links.where(F.col("a") != F.col("b"))
    return ends.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _state(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    joined = larger.join(least, "a")
    return _oriented(joined.select(F.col("b").alias("a"), F.least("a", "m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(others.unionAll(least.select("a", F.col("m").alias("b"))))
