"""Exact repeated byte strings: suffixes at anchors, sorted by a distributed merge of front-coded runs.

Whether a string of ``length`` bytes starts anywhere else is asked for every position. Positions
share the work through anchors: each start is served by the place with the smallest hash of 16
bytes in the window of ``WINDOW`` places that begins at it. That choice depends on bytes of the
string alone, so equal strings have their anchors at equal distances, and comparing the text right
and left of anchors decides all starts. About one place in 64 is an anchor.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikeloom.llm.suffix_runs import decoded, front_coded, merged
from strikeloom.sinks.shared import stored

LENGTH = 200
WINDOW, GRAM = 128, 16
ENTRIES_AT_ONCE = 50_000
_LEFT_BASE = np.uint64(0x9E3779B97F4A7C15)


def anchors(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text, with the least and greatest distance to the starts each serves."""
    n = len(data)
    if n < length:
        return (np.zeros(0, np.int64),) * 3
    eights = np.ndarray((n - 7,), "<u8", data, strides=(1,)).astype(np.uint64)
    h = eights[:-8] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= (eights[8:] + np.uint64(1)) * np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    # Hash above, place below: the smallest hash wins, the leftmost of equal ones.
    h &= np.uint64(0xFFFFFFFF00000000)
    h |= np.arange(len(h), dtype=np.uint64)
    span = 1
    while span < WINDOW:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    place = (h[: n - length + 1] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.append(first[1:], len(place)) - 1
    p = place[first]
    return p, p - last, p - first


def _keyed(docs: DataFrame) -> DataFrame:
    """(id1, id2, data): texts as bytes under an identity that rows share only if they are equal."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select("doc_id", data.alias("data")).select(
        F.xxhash64("doc_id", "data").alias("id1"),
        F.octet_length("data").cast("long").alias("id2"),
        "doc_id",
        "data",
    )


def _shared_anchors(keyed: DataFrame, length: int) -> DataFrame:
    """Rows (id1, id2, places): anchors whose next bytes, as many as any match needs, occur twice."""
    least = length - WINDOW + 1

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            keys, places, rows = [], [], []
            for row, data in enumerate(batch["data"]):
                data = data.as_py()
                p, near, far = anchors(data, length)
                keys += [digest(data[i : i + least]) for i in p.tolist()]
                places.append(p << 16 | near << 8 | far)
                rows.append(np.full(len(p), row))
            if not keys:
                continue
            take = pa.array(np.concatenate(rows))
            yield pa.record_batch(
                {
                    "key": pa.array(np.array(keys, np.uint64).view(np.int64)),
                    "id1": batch["id1"].take(take),
                    "id2": batch["id2"].take(take),
                    "place": pa.array(np.concatenate(places)),
                }
            )

    rows = keyed.select("id1", "id2", "data").mapInArrow(
        listed, "key bigint, id1 bigint, id2 bigint, place bigint"
    )
    twice = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    # Stored, the keys are dealt anew for the join, which can then split a key that many share.
    return rows.join(stored(twice), "key", "left_semi").groupBy("id1", "id2").agg(
        F.collect_set("place").alias("places")
    )


def _context(data: bytes, place: int, length: int) -> tuple[bytes, bytes, int, int, bytes]:
    """Text right of an anchor, text left of it read backwards, distances, and a digest of these."""
    p, near, far = place >> 16, place >> 8 & 0xFF, place & 0xFF
    right, left = data[p : p - near + length], data[p - far : p]
    mark = xxhash.xxh3_128_digest(bytes((near, far)) + left + right)
    return right, left[::-1], near, far, mark


def _contexts(joined: DataFrame, length: int) -> DataFrame:
    """Rows (id1, id2, place, mark1, mark2) of the shared anchors."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, marks = [], [], []
            for row, (data, own) in enumerate(zip(batch["data"], batch["places"])):
                data = data.as_py()
                for place in own.as_py():
                    rows.append(row)
                    places.append(place)
                    marks.append(_context(data, place, length)[4])
            pair = np.frombuffer(b"".join(marks), np.int64).reshape(-1, 2)
            take = pa.array(np.array(rows, np.int64))
            yield pa.record_batch(
                {
                    "id1": batch["id1"].take(take),
                    "id2": batch["id2"].take(take),
                    "place": pa.array(np.array(places, np.int64)),
                    "mark1": pa.array(np.ascontiguousarray(pair[:, 0])),
                    "mark2": pa.array(np.ascontiguousarray(pair[:, 1])),
                }
            )

    return joined.mapInArrow(
        marked, "id1 bigint, id2 bigint, place bigint, mark1 bigint, mark2 bigint"
    )


def _runs(joined: DataFrame, length: int, parts: int) -> DataFrame:
    """Rows (part, run, rest): front-coded sorted runs of the distinct contexts of each task.

    Contexts go to the part of their first bytes, as many as any match needs. ``rest`` has what
    belongs to each string: text on the left, distances, digest, number of anchors.
    """
    least = length - WINDOW + 1

    def sorted_runs(held: dict) -> Iterator[pa.RecordBatch]:
        by_part: dict[int, list] = {}
        for (right, left, near, far, mark), n in held.items():
            part = xxhash.xxh3_64_intdigest(right[:least]) % parts
            by_part.setdefault(part, []).append((right, left, near, far, mark, n))
        out = []
        for part, entries in by_part.items():
            entries.sort()
            lefts = b"".join(e[1] for e in entries)
            table = np.array([(e[2], e[3], min(e[5], 2)) for e in entries], np.uint8)
            marks = b"".join(e[4] for e in entries)
            rest = len(entries).to_bytes(4, "little") + table.tobytes() + marks + lefts
            out.append((part, front_coded([e[0] for e in entries]), rest))
        if out:
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary()))]
            yield pa.record_batch(columns, names=["part", "run", "rest"])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for data, own in zip(batch["data"], batch["places"]):
                data = data.as_py()
                for place in own.as_py():
                    context = _context(data, place, length)
                    held[context] = held.get(context, 0) + 1
                if len(held) >= ENTRIES_AT_ONCE:
                    yield from sorted_runs(held)
                    held = {}
        yield from sorted_runs(held)

    return joined.mapInArrow(
        coded, "part bigint, run binary, rest binary"
    )


def _unpacked(rest: bytes):
    n = int.from_bytes(rest[:4], "little")
    table = np.frombuffer(rest, np.uint8, 3 * n, 4).reshape(n, 3)
    marks = np.frombuffer(rest, np.int64, 2 * n, 4 + 3 * n).reshape(n, 2)
    lefts = np.frombuffer(rest, np.uint8, -1, 4 + 19 * n)
    return table, marks, lefts


def repeated_starts(runs: list[bytes], rests: list[bytes], length: int = LENGTH):
    """(marks, masks): for each context the distances of its starts whose string occurs twice.

    A mask has a bit per distance, in two longs. Runs are merged; then, for each distance d, two
    contexts agree if their right sides share ``length - d`` bytes, which are neighbours in the
    order, and their left sides ``d`` bytes.
    """
    tables = [_unpacked(rest) for rest in rests]
    offsets = np.cumsum([0, *(len(t[0]) for t in tables)])
    table = np.concatenate([t[0] for t in tables])
    marks = np.concatenate([t[1] for t in tables])
    source, shared = [], []
    seen = [0] * len(runs)
    for run, known in merged([decoded(run) for run in runs]):
        source.append(offsets[run] + seen[run])
        shared.append(known)
        seen[run] += 1
    source, shared = np.array(source), np.array(shared)
    sizes = table[:, 1].astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    lefts = np.concatenate([t[2] for t in tables] + [np.zeros(WINDOW, np.uint8)])
    near, far, many = table[source, 0], table[source, 1], table[source, 2] > 1
    start = starts[source]
    hashed = np.zeros(len(source), np.uint64)
    flags = np.zeros((len(source), WINDOW), bool)
    for d in range(WINDOW):
        if d:
            hashed = (hashed + lefts[np.minimum(start + d - 1, len(lefts) - 1)] + np.uint64(1)) * _LEFT_BASE
            hashed ^= hashed >> np.uint64(31)
        own = np.flatnonzero((near <= d) & (far >= d))
        if not len(own):
            continue
        group = np.cumsum(shared < length - d)[own].astype(np.uint64)
        key = hashed[own] ^ (group * np.uint64(0xD6E8FEB86659FD93))
        order = np.argsort(key)
        ranked = key[order]
        same = ranked[1:] == ranked[:-1]
        twin = np.zeros(len(own), bool)
        twin[order[1:][same]] = True
        twin[order[:-1][same]] = True
        flags[own, d] = twin | many[own]
    hit = flags.any(axis=1)
    masks = np.packbits(flags[hit], axis=1, bitorder="little").view(np.int64)
    return marks[source[hit]], masks


def _merged_masks(runs: DataFrame, length: int) -> DataFrame:
    """Rows (mark1, mark2, mask1, mask2) from the runs of each part."""

    def decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rests = [], []
        for batch in batches:
            held += batch["run"].to_pylist()
            rests += batch["rest"].to_pylist()
        if held:
            marks, masks = repeated_starts(held, rests, length)
            columns = [*marks.T, *masks.T]
            names = ["mark1", "mark2", "mask1", "mask2"]
            yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)

    rows = runs.repartition("part").mapInArrow(
        decided, "mark1 bigint, mark2 bigint, mask1 bigint, mask2 bigint"
    )
    return rows.groupBy("mark1", "mark2").agg(
        F.bit_or("mask1").alias("mask1"), F.bit_or("mask2").alias("mask2")
    )


def covered(n: int, places: list[tuple[int, int, int]], length: int = LENGTH) -> np.ndarray:
    """Which of ``n`` bytes lie in a repeated string, from (place, mask1, mask2) of its anchors."""
    table = np.array(places, np.int64).reshape(-1, 3)
    bits = np.unpackbits(np.ascontiguousarray(table[:, 1:]).view(np.uint8), axis=1, bitorder="little")
    row, d = np.nonzero(bits)
    start = (table[row, 0] >> 16) - d
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change)[:n] > 0


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Every text without the bytes of strings of ``length`` bytes that start anywhere else as well.

    Texts are UTF-8 bytes. Strings lie within one text, count wherever else they start, in the same
    text too, and are judged on the input; all their occurrences go.

    Returns doc_id, n_bytes, spans (removed runs: array of start, end), kept (the other bytes
    joined), one row per input row. NULL and empty texts, and texts shorter than ``length``, lose
    nothing. NULL ids are texts like others. Repeated rows repeat each other's strings. An empty
    table gives an empty result; other columns are ignored.
    """
    if not WINDOW + GRAM <= length <= 255:
        raise ValueError(f"strings of {WINDOW + GRAM} to 255 bytes can be found")
    spark = docs.sparkSession
    keyed = _keyed(docs)
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # All three uses of the texts ask for the same columns, so that they share one shuffle.
    columns = ("id1", "id2", "doc_id", "data")
    joined = keyed.join(_shared_anchors(keyed, length), ["id1", "id2"]).select(*columns, "places")
    masks = _merged_masks(_runs(joined, length, parts), length)
    hits = _contexts(joined, length).join(masks, ["mark1", "mark2"])
    by_doc = hits.groupBy("id1", "id2").agg(
        F.collect_set(F.struct("place", "mask1", "mask2")).alias("hits")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept, sizes = [], [], []
            for data, hits in zip(batch["data"], batch["hits"]):
                data, hits = data.as_py(), hits.as_py()
                sizes.append(len(data))
                if not hits:
                    spans.append([])
                    kept.append(data)
                    continue
                gone = covered(len(data), [tuple(h.values()) for h in hits], length)
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0])).astype(np.int8)))
                spans.append([{"start": int(i), "end": int(j)} for i, j in edges.reshape(-1, 2)])
                kept.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "n_bytes": pa.array(sizes, pa.int64()),
                    "spans": pa.array(spans, span),
                    "kept": pa.array(kept, pa.binary()),
                }
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = keyed.join(by_doc, ["id1", "id2"], "left").select(*columns, "hits")
    return rows.mapInArrow(
        cut, f"doc_id {kind}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    )
