"""WARC archives: writing pages as records, reading them back, reassembling segments."""

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikeloom.sinks.shared import shared_folder, stored

CRLF = b"\r\n"
SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4 * 1024
RECORDS_PER_FILE = 5000
# Fixed values of the format.
VERSION = b"WARC/1.1"
DATE = "2025-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARSED = (
    "record_id string, page_id string, record_type string, digest string, refers_page string, "
    "origin_id string, segment int, total_length bigint, block binary"
)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with payload, digest and, for those that repeat a payload, the page they refer to.

    Of pages with equal payloads of at least ``min_bytes`` bytes that with the largest id answers;
    the others refer to it. A payload that a third of all pages share is one row per task in the
    aggregate; handing the answer back is a join that adaptive execution splits.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    answers = rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("answer"), F.count(F.lit(1)).alias("n")
    )
    # Only payloads met twice matter; stored, they are dealt anew and a hot one can be split.
    answers = stored(answers.where("n > 1").drop("n"))
    other = ~F.col("page_id").eqNullSafe(F.col("answer")) & F.col("answer").isNotNull()
    big = F.octet_length("payload") >= min_bytes
    return rows.join(answers, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(other & big, F.col("answer")).alias("refers_to")
    )


def _chunked(body: bytes, size: int) -> bytes:
    parts = [body[i : i + size] for i in range(0, len(body), size)]
    framed = [b"%x\r\n%b\r\n" % (len(part), part) for part in parts]
    return b"".join([*framed, b"0\r\n\r\n"])


def decode_chunked(framed: bytes) -> bytes:
    """The body of a chunked transfer; extensions and trailers are skipped, a cut one is an error."""
    parts, at = [], 0
    while True:
        end = framed.index(CRLF, at)
        size = int(framed[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if framed[at + size : at + size + 2] != CRLF:
            raise ValueError("a chunk does not end where its size says")
        parts.append(framed[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields)]
    lines.append(b"Content-Length: %d" % len(block))
    return CRLF.join(lines) + CRLF + CRLF + block


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(value: str) -> str:
    return " ".join(value.split())


def records_of(
    number: int, page: str | None, url: str | None, payload: bytes, digest: str, refers: str | None
) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response with its continuations."""
    record = f"<urn:x-page:{page}:{number}>"
    head = [("WARC-Date", DATE), ("WARC-Target-URI", _one_line(url or "urn:x-page:none"))]
    head += [("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}")]
    head += [("X-Page-ID", page)] if page is not None else []
    if refers is not None:
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", record), *head]
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:x-page:{refers}>")]
        fields += [("X-Refers-To-Page", refers), ("Content-Type", "application/http;msgtype=response")]
        yield _record(fields, b"HTTP/1.1 200 OK\r\n\r\n")
        return
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + _chunked(payload, CHUNK_BYTES)
    parts = [block[i : i + SEGMENT_BYTES] for i in range(0, len(block), SEGMENT_BYTES)]
    kind = ("Content-Type", "application/http;msgtype=response")
    for k, part in enumerate(parts, 1):
        first = k == 1
        name = record if first else f"{record[:-1]}:{k}>"
        fields = [("WARC-Type", "response" if first else "continuation"), ("WARC-Record-ID", name)]
        fields += [*head, kind] if first else [head[0], head[1], ("WARC-Segment-Origin-ID", record)]
        if len(parts) > 1:
            fields.append(("WARC-Segment-Number", str(k)))
        if not first and k == len(parts):
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _record(fields, part)


def write_archives(pages: DataFrame, folder: str) -> None:
    """Write ``with_revisits`` rows as gzip-compressed WARC files, a bounded number of records each."""

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch[name].to_pylist() for name in batch.schema.names))
            out = [record for row in rows for record in records_of(*row)]
            for at in range(0, len(out), 1000):
                yield pa.record_batch({"record": pa.array(out[at : at + 1000], pa.binary())})

    rows = pages.select(
        F.monotonically_increasing_id().alias("number"),
        F.col("page_id").cast("string").alias("page"),
        "url",
        "payload",
        "digest",
        F.col("refers_to").cast("string").alias("refers"),
    )
    # The text sink writes a binary value's bytes as they are; a record ends with two line ends.
    lines = rows.mapInArrow(framed, "record binary").select(F.col("record").cast("string"))
    (
        lines.write.option("lineSep", "\r\n\r\n")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(folder)
    )


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record; lengths decide, not markers."""
    at = 0
    while at < len(data):
        end = data.index(CRLF + CRLF, at)
        first, *lines = data[at:end].split(CRLF)
        if not first.startswith(b"WARC/"):
            raise ValueError("a record does not start where the last one ended")
        fields = {}
        for line in lines:
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        start = end + 4
        stop = start + int(fields["content-length"])
        if data[stop : stop + 4] != CRLF + CRLF:
            raise ValueError("a record's block is not as long as its header says")
        yield fields, data[start:stop]
        at = stop + 4


def read_archives(spark, folder: str) -> DataFrame:
    """One row per record of the WARC files in ``folder``; a file is parsed by one task."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in PARSED.split(", ")]
        kinds = [pa.string()] * 6 + [pa.int32(), pa.int64(), pa.binary()]
        schema = pa.schema(list(zip(names, kinds)))
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for fields, block in parse_records(gzip.decompress(content.as_py())):
                    rows.append(_row(fields, block))
                    if len(rows) == 1000:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], schema=schema)
                        rows = []
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(parsed, PARSED)


def _row(fields: dict[str, str], block: bytes) -> tuple:
    total = fields.get("warc-segment-total-length")
    return (
        fields["warc-record-id"],
        fields.get("x-page-id"),
        fields["warc-type"],
        fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        fields.get("x-refers-to-page"),
        fields.get("warc-segment-origin-id"),
        int(fields.get("warc-segment-number", 0)),
        None if total is None else int(total),
        block,
    )


def reassembled(records: DataFrame) -> DataFrame:
    """Whole records from ``read_archives`` rows: continuations joined to their origins.

    Records in one piece pass by the shuffle. The others are grouped by origin id, so a group is
    one record, ordered by segment number, and checked: numbers run from 1 without gaps and the
    bytes add up to the declared total. A record that fails is an error, never a short payload.
    """
    alone = records.where("segment = 0").drop("origin_id", "segment", "total_length")
    pieces = records.where("segment > 0").withColumn(
        "origin_id", F.coalesce("origin_id", "record_id")
    )
    first = F.col("segment") == 1
    grouped = pieces.groupBy("origin_id").agg(
        *[
            F.max(F.when(first, F.col(name))).alias(name)
            for name in ("page_id", "record_type", "digest", "refers_page")
        ],
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
        F.max("total_length").alias("total"),
    )
    numbers = F.transform("parts", lambda part: part["segment"])
    size = F.aggregate(
        "parts", F.lit(0).cast("long"), lambda n, part: n + F.octet_length(part["block"])
    )
    block = F.aggregate(
        "parts", F.lit(b"").cast("binary"), lambda whole, part: F.concat(whole, part["block"])
    )
    sound = (numbers == F.sequence(F.lit(1), F.size("parts"))) & size.eqNullSafe(F.col("total"))
    checked = F.when(sound, block).otherwise(
        F.raise_error(F.concat(F.lit("segments missing or cut: "), "origin_id"))
    )
    joined = grouped.select(
        F.col("origin_id").alias("record_id"),
        "page_id",
        "record_type",
        "digest",
        "refers_page",
        checked.alias("block"),
    )
    return alone.unionByName(joined)


def payloads(records: DataFrame) -> DataFrame:
    """Rows (record_id, page_id, record_type, digest, refers_page, payload) of whole HTTP records.

    The transfer coding is decoded and the payload held against the digest its record declares. A
    revisit has no payload of its own (NULL).
    """

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = ("record_type", "block", "digest")
            for kind, block, digest in zip(*(batch[name].to_pylist() for name in columns)):
                head, _, body = block.partition(CRLF + CRLF)
                if kind == "revisit":
                    body = None
                elif b"transfer-encoding: chunked" in head.lower():
                    body = decode_chunked(body)
                if body is not None and digest is not None and payload_digest(body) != digest:
                    raise ValueError("a payload does not have the digest its record declares")
                out.append(body)
            kept = {n: batch[n] for n in batch.schema.names if n != "block"}
            yield pa.record_batch(kept | {"payload": pa.array(out, pa.binary())})

    names = ("record_id", "page_id", "record_type", "digest", "refers_page")
    schema = ", ".join(f"{name} string" for name in names) + ", payload binary"
    return records.select(*names, "block").mapInArrow(decoded, schema)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives, read them back, and describe each page.

    Returns page_id, payload_bytes, payload_digest (base32 SHA-1), record_type and refers_to, one
    row per input row. A NULL html is an empty payload, and empty payloads equal each other. A row
    with a NULL page_id gets a record; it refers to the largest id of its payload, if there is one.
    Rows that repeat the largest id are all responses. A revisit's size is that of the response
    it refers to. An empty table gives an empty result; other columns are ignored.
    """
    spark = pages.sparkSession
    kind = pages.schema["page_id"].dataType.simpleString()
    folder = shared_folder(spark)
    write_archives(with_revisits(pages, min_bytes), folder)
    found = payloads(reassembled(read_archives(spark, folder)))
    described = stored(
        found.select(
            F.col("page_id").cast(kind).alias("page_id"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.col("digest").alias("payload_digest"),
            "record_type",
            F.col("refers_page").cast(kind).alias("refers_to"),
        )
    )
    sizes = described.where("record_type = 'response'").groupBy("payload_digest").agg(
        F.max("payload_bytes").alias("size")
    )
    return described.join(sizes, "payload_digest", "left").select(
        "page_id",
        F.coalesce("payload_bytes", "size").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )
