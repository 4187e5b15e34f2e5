"""Web archives: pages written as WARC records, and records read back and put together.

A long record is written in segments: a first record, then continuation records that name it as their
origin. Bodies are framed as chunks. Reading groups segments by origin, orders them by number,
verifies the total length and takes the chunk framing off.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import checkpointed
from .common import batch_of, col

END = b"\r\n\r\n"
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
BROADCAST_ROWS = 500_000  # of digest and id, about 100 bytes each
RECORD = (
    "record_id string, record_type string, page_id long, url string, refers_to long, "
    "payload_digest string, origin_id string, segment int, total_length long, block binary"
)


def framed(payload: bytes, chunk: int) -> bytes:
    """`payload` in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), chunk):
        piece = payload[at : at + chunk]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join(parts) + b"0\r\n\r\n"


def unframed(body: bytes) -> bytes:
    """The payload of a chunked body. Chunk extensions and trailers are skipped; a body that
    ends early or has a wrong size raises ValueError."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunked body ends early")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk does not have its stated size")
        parts.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP response, with chunked framing taken off."""
    head, _, body = block.partition(END)
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"transfer-encoding" and value.strip().lower() == b"chunked":
            return unframed(body)
    return body


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without the blank lines that end it. Absent fields are left out."""
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in fields if value is not None)]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + END + block


def records_of(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
    is_revisit: bool, segment_bytes: int, chunk_bytes: int,
) -> Iterator[bytes]:
    """The records of one page."""
    if url is not None:  # no control character may end a header line
        url = "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
    origin = f"<urn:uuid:{uuid.uuid4()}>"
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = head + b"\r\n" if is_revisit else head + b"Transfer-Encoding: chunked" + END + framed(payload, chunk_bytes)
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    for number, part in enumerate(parts, 1):
        last = number == len(parts) > 1
        fields = [
            ("WARC-Type", "continuation" if number > 1 else "revisit" if is_revisit else "response"),
            ("WARC-Record-ID", origin if number == 1 else f"<urn:uuid:{uuid.uuid4()}>"),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", url),
            ("WARC-Segment-Number", number if len(parts) > 1 else None),
            ("WARC-Segment-Origin-ID", origin if number > 1 else None),
            ("WARC-Segment-Total-Length", len(block) if last else None),
        ]
        if number == 1:
            fields += [
                ("Content-Type", "application/http; msgtype=response"),
                ("WARC-Payload-Digest", f"sha256:{digest}"),
                ("WARC-Profile", PROFILE if is_revisit else None),
                ("X-Page-Id", page_id),
                ("X-Refers-To-Page-Id", refers_to if is_revisit else None),
            ]
        yield _record(fields, part)


def write_warc(
    df: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    *,
    least_revisit: int = 100,
    segment_bytes: int = 65_536,
    chunk_bytes: int = 8_192,
    records_per_file: int = 2_048,
) -> None:
    """Writes every row as a record into archive files under `path` (gzip).

    Of rows with equal payloads of at least `least_revisit` bytes the least id is the response and others refer to it.
    Rows that repeat that id are responses too. A null payload is empty; a null id is never
    referred to; an empty table writes files without records. A file holds at most `records_per_file` records
    of at most `segment_bytes`, so it can be read back in bounded memory.
    """
    pages = df.select(
        col(id_col).cast("long").alias("id"),
        col(url_col).cast("string").alias("url"),
        F.coalesce(col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    firsts = checkpointed(
        pages.where(F.octet_length("payload") >= least_revisit)
        .groupBy("digest")
        .agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .drop("n")
    )
    if firsts.count() <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)  # else a shuffle, whose hot digests AQE splits
    schema = pa.schema([("record", pa.binary())])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page_id, url, payload, digest, first = row
                revisit = first is not None and first != page_id
                made = [*records_of(page_id, url, payload, digest, first, revisit, segment_bytes, chunk_bytes)]
                out += made
                held += sum(map(len, made))
                if held > 8_000_000:
                    yield batch_of(schema, out)
                    out, held = [], 0
            yield batch_of(schema, out)

    placed = pages.join(firsts, "digest", "left").select("id", "url", "payload", "digest", "first_id")
    lines = placed.mapInArrow(records, "record binary").select(F.col("record").cast("string"))
    # A record's bytes are written as they are; the two blank lines that end it are the separator.
    lines.write.option("lineSep", END.decode()).option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_file
    ).text(path)


def parsed(archive: bytes) -> Iterator[dict]:
    """The records of one archive, by their stated lengths. Damage raises ValueError."""
    at = 0
    while at < len(archive):
        end = archive.find(END, at)
        if end < 0:
            raise ValueError(f"record header at byte {at} does not end")
        version, *lines = archive[at:end].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {}
        for line in lines:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        start = end + len(END)
        at = start + int(fields["content-length"])
        block = archive[start:at]
        if archive[at : at + len(END)] != END:
            raise ValueError("record does not have its stated length")
        at += len(END)
        yield fields | {"block": block}


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archive files under `path`, plain or gzip."""
    names = ("warc-record-id", "warc-type", "x-page-id", "warc-target-uri", "x-refers-to-page-id",
             "warc-payload-digest", "warc-segment-origin-id", "warc-segment-number",
             "warc-segment-total-length", "block")
    numbers = {"x-page-id", "x-refers-to-page-id", "warc-segment-number", "warc-segment-total-length"}
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(),
             pa.int32(), pa.int64(), pa.binary()]
    schema = pa.schema([(f.split()[0], k) for f, k in zip(RECORD.split(", "), kinds, strict=True)])

    def value(record: dict, name: str):
        found = record.get(name)
        return int(found) if found is not None and name in numbers else found

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                archive = content.as_py()
                if archive[:2] == b"\x1f\x8b":
                    archive = gzip.decompress(archive)
                out, held = [], 0
                for record in parsed(archive):
                    out.append([value(record, n) for n in names])
                    held += len(record["block"])
                    if held > 8_000_000:
                        yield batch_of(schema, *zip(*out, strict=True))
                        out, held = [], 0
                if out:
                    yield batch_of(schema, *zip(*out, strict=True))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(read, RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: `record_id, record_type, page_id, url, refers_to, payload_digest, payload, complete`.

    Segments of one origin come together by number. A record is complete if the numbers run from 1 without
    gap or repeat, the last one states the total length and the blocks add up to it; otherwise it stays, with a
    null payload. Only segmented records are shuffled; a group is one record.
    """
    head = ["record_id", "record_type", "page_id", "url", "refers_to", "payload_digest"]
    single = records.where("origin_id IS NULL AND segment IS NULL").select(
        *head, F.array("block").alias("blocks"), F.lit(True).alias("complete")
    )
    parts = records.where("origin_id IS NOT NULL OR segment IS NOT NULL")
    segments = F.sort_array(F.collect_list(F.struct("segment", "block", "total_length")))
    first = {name: F.max(F.when(F.col("segment") == 1, F.col(name))).alias(name) for name in head}
    joined = parts.groupBy(F.coalesce("origin_id", "record_id").alias("origin")).agg(
        segments.alias("segments"), *first.values()
    )
    length = F.aggregate("segments", F.lit(0).cast("long"), lambda n, s: n + F.length(s["block"]))
    complete = (
        F.transform("segments", lambda s: s["segment"]) == F.sequence(F.lit(1), F.size("segments"))
    ) & (F.element_at("segments", -1)["total_length"] == length)
    joined = joined.select(
        F.coalesce("record_id", "origin").alias("record_id"), *head[1:],
        F.transform("segments", lambda s: s["block"]).alias("blocks"),
        F.coalesce(complete, F.lit(False)).alias("complete"),
    )
    whole = single.unionByName(joined)
    place = whole.columns.index("blocks")
    ddl = "record_id string, record_type string, page_id long, url string, refers_to long, payload_digest string, payload binary, complete boolean"

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = batch.column(place + 1).to_pylist()
            payloads = [
                payload_of(b"".join(blocks)) if ok else None
                for blocks, ok in zip(batch.column(place).to_pylist(), done, strict=True)
            ]
            columns = [*batch.columns[:place], pa.array(payloads, pa.binary()), batch.column(place + 1)]
            yield pa.RecordBatch.from_arrays(columns, names=[*head, "payload", "complete"])

    return whole.mapInArrow(unpack, ddl)


def page_payloads(records: DataFrame) -> DataFrame:
    """Per reassembled record: `page_id, payload_bytes, payload_digest, record_type, refers_to`, both
    of the full payload: a revisit has those of the response it refers to, which must have the
    digest that the revisit states (else both are null)."""
    facts = checkpointed(
        records.select(
            "page_id", "record_type", "refers_to",
            F.length("payload").cast("long").alias("payload_bytes"),
            F.sha2("payload", 256).alias("digest"),
            F.regexp_replace("payload_digest", "^sha256:", "").alias("stated"),
        )
    )
    plain = facts.where("record_type <> 'revisit'").select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    targets = plain.groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("stated")).agg(
        F.max("payload_bytes").alias("payload_bytes")
    ).withColumn("payload_digest", F.col("stated"))
    revisits = facts.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "stated")
    return plain.unionByName(revisits.join(targets, ["refers_to", "stated"], "left").select(plain.columns))
