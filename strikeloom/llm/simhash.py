"""Near-duplicate documents by SimHash fingerprints and covering-code anchors."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikeloom.llm import golay
from strikeloom.llm.components import components
from strikeloom.llm.identity import fresh_name, row_identity
from strikeloom.sinks.shared import stored

SEED = 42
# Groups up to this size are compared by shifts, up to the next by a distance matrix.
SMALL, MEDIUM = 8, 2048


def fingerprint(text: bytes, shingle: int) -> int:
    """The SimHash of a text: a bit is 1 if set in over half of the shingles' hashes."""
    words = text.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(joined)]))
    if len(words) > shingle:
        starts, ends = starts[: -(shingle - 1) or None], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[i:j], SEED) for i, j in zip(starts.tolist(), ends.tolist())),
        np.uint64,
        len(starts),
    )
    ones = np.zeros(64, np.int64)
    for part in np.array_split(hashes, len(hashes) // 65536 + 1):
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """Rows (doc_id, fp): the fingerprint of each whole text, as a signed long. NULL counts as empty."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array(
                [fingerprint(text or b"", shingle) for text in batch["text"].to_pylist()], np.uint64
            )
            yield pa.record_batch({"doc_id": batch["doc_id"], "fp": pa.array(found.view(np.int64))})

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(hashed, f"doc_id {kind}, fp bigint")


def anchored(fps: DataFrame, max_bits: int) -> DataFrame:
    """Rows (anchor, fp): each fingerprint at every anchor within covering radius plus ``max_bits``.

    Anchors are pairs of Golay code words over the first 46 bits, 2^24 of them with a covering
    radius of 6. Fingerprints that differ in ``max_bits`` bits or fewer both lie that close to the
    code word nearest to one of them, so they meet there.
    """
    reach = 2 * golay.RADIUS + max_bits

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch["fp"].to_numpy(zero_copy_only=False)
            for at in range(0, len(every), 4096):
                some = every[at : at + 4096]
                first, second = some & golay.MASK, (some >> golay.LENGTH) & golay.MASK
                for rows, pairs in golay.codeword_pairs(first, second, reach):
                    yield pa.record_batch({"anchor": pa.array(pairs), "fp": pa.array(some[rows])})

    return fps.mapInArrow(placed, "anchor bigint, fp bigint")


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits; counted unsigned, since the count of a negative number is of its magnitude."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _by_shifts(anchors: np.ndarray, fps: np.ndarray, max_bits: int):
    for shift in range(1, SMALL):
        a, b = fps[:-shift], fps[shift:]
        near = (anchors[:-shift] == anchors[shift:]) & (_distance(a, b) <= max_bits)
        yield a[near], b[near]


def _group_links(fps: np.ndarray, max_bits: int):
    """Links from members to the first member of their component within one anchor's group."""
    n = len(fps)
    root = np.arange(n)
    if n <= MEDIUM:
        near = _distance(fps[:, None], fps[None, :]) <= max_bits
        while True:
            least = np.where(near, root[None, :], n).min(axis=1)
            least = least[least]
            if (least == root).all():
                break
            root = least
    else:
        order = np.argsort(fps)
        ranked = fps[order]
        flips = _flips(max_bits)
        changed = True
        while changed:
            before = root.copy()
            for flip in flips:
                sought = ranked ^ flip
                at = np.minimum(np.searchsorted(ranked, sought), n - 1)
                hit = ranked[at] == sought
                root[hit] = np.minimum(root[hit], root[at[hit]])
            root = root[root]
            changed = (before != root).any()
        fps = ranked
    other = root != np.arange(n)
    return fps[other], fps[root[other]]


def _flips(max_bits: int) -> np.ndarray:
    masks = {0}
    for _ in range(max_bits):
        masks |= {m ^ (1 << bit) for m in masks for bit in range(64)}
    return np.array(sorted(masks - {0}), np.uint64).view(np.int64)


def compared(rows: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) of at most ``max_bits`` bits among the fingerprints of each anchor.

    Rows arrive sorted by anchor and one group is held at a time. A group holds distinct
    fingerprints, eight bytes each, so copies do not enlarge it. Small groups give their links;
    larger ones only what connects the same components, so never all pairs.
    """

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            anchors = batch["anchor"].to_numpy(zero_copy_only=False)
            fps = batch["fp"].to_numpy(zero_copy_only=False)
            if not len(anchors):
                continue
            if held and held[0][0][0] == anchors[-1]:
                held.append((anchors, fps))
                continue
            cut = np.searchsorted(anchors, anchors[-1])
            whole = [*held, (anchors[:cut], fps[:cut])]
            held = [(anchors[cut:], fps[cut:])]
            yield from _found(*map(np.concatenate, zip(*whole)))
        if held:
            yield from _found(*map(np.concatenate, zip(*held)))

    def _found(anchors: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(anchors) < 2:
            return
        starts = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
        sizes = np.diff(np.append(starts, len(anchors)))
        small = np.repeat(sizes <= SMALL, sizes)
        pairs = list(_by_shifts(anchors[small], fps[small], max_bits)) if small.any() else []
        for k in np.flatnonzero(sizes > SMALL):
            pairs.append(_group_links(fps[starts[k] : starts[k] + sizes[k]], max_bits))
        a, b = map(np.concatenate, zip(*pairs))
        if len(a):
            yield pa.record_batch({"a": pa.array(a), "b": pa.array(b)})

    placed = rows.repartition("anchor").sortWithinPartitions("anchor")
    return placed.mapInArrow(links, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Fingerprint and component of every document, one row per input row.

    Texts are lower-cased in A-Z and cut into words at ASCII white space; shingles of ``shingle``
    words, repeats included, are hashed (fewer words: the whole sequence). Documents whose
    fingerprints differ in at most ``max_bits`` bits are linked; ``component_id`` is the smallest
    ``doc_id`` reachable. Equal fingerprints are one node, so groups of copies cost nothing more.

    Returns doc_id, fp (signed long), fingerprint (16 hex digits), component_id. NULL and empty
    texts have fingerprint zero and link like others. A NULL ``doc_id`` gets its row; it counts in
    no minimum, so a component of such rows alone has a NULL id. Repeated rows stay repeated. An
    empty table gives an empty result. Other columns are ignored.
    """
    marked = stored(fingerprints(docs, shingle))
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    links = compared(anchored(nodes.select("fp"), max_bits), max_bits)
    roots = components(links).withColumnRenamed("node", "fp")
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = placed.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select(
        "doc_id",
        "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_per_group(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Documents without near-duplicates: one row of each component stays.

    That is the row with the smallest ``doc_id``; a row without an id stays only where its component
    has no row with one, and of different texts under the same smallest id (or under none) the one
    with the smallest hash does. Different texts of one id are told apart: each is judged in its own
    component. Of rows that repeat both id and text one stays. Other columns, whatever their names,
    are kept.
    """
    named = {"id": fresh_name("id"), "kept": fresh_name("kept")}
    rows = docs.withColumn(named["id"], row_identity())
    groups = near_duplicates(rows.select(F.col(named["id"]).alias("doc_id"), "text"), shingle, max_bits)
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select(
        F.col("doc_id").alias(named["kept"])
    )
    chosen = rows.join(kept.distinct(), F.col(named["id"]) == F.col(named["kept"]), "left_semi")
    return chosen.dropDuplicates([named["id"]]).drop(named["id"])
