"""WARC archives of pages: records compressed one by one against a dictionary made of such records."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import small, stage

#: Records, about, from which the dictionary is made, the bytes that each gives at most, and its size.
SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES = 1_000, 8_192, 112_640
LEVEL = 3
#: Payloads of fewer bytes are archived whole, however often they occur.
LEAST_SHARED = 100
#: The date of records whose capture time is unknown.
DATE = "1970-01-01T00:00:00Z"
#: Fixed value: the mark of the skippable frame that holds the dictionary of an archive.
DICTIONARY_FRAME = 0x184D2A5D
#: Skippable frames have marks that are equal but for the last four bits.
SKIPPABLE_FRAME = 0x184D2A50
#: An empty skippable frame, which Spark's text sink writes after each row: no reader sees it.
BETWEEN_ROWS = "P*M\x18\0\0\0\0"
#: Fixed value: the profile of a record whose payload is that of another one.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records of one batch that a task returns, and the bytes after which it is cut.
BATCH, BATCH_BYTES = 1_000, 1 << 24


def record_id(page_id: int | None, row: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id}:{row}'.encode()).digest()[:16], version=5)}>"


def _field(name: str, value: object) -> bytes:
    """A header line, none for null; control characters are percent-encoded."""
    if value is None:
        return b""
    text = re.sub(r"[\x00-\x1f\x7f]", lambda c: f"%{ord(c[0]):02X}", str(value))
    return f"{name}: {text}\r\n".encode()


def record(page_id, row, url, payload, size, digest, head, date) -> bytes:
    """A WARC record; head is (page_id, row, url) of the record that has the payload, or null."""
    http = b"HTTP/1.1 200 OK\r\n" + _field("Content-Type", "text/html; charset=utf-8") + _field("Content-Length", size) + b"\r\n"
    block = http if head is not None else http + payload
    fields = [("WARC-Type", "response" if head is None else "revisit"), ("WARC-Record-ID", record_id(page_id, row))]
    fields += [("WARC-Date", date), ("WARC-Target-URI", url), ("Page-ID", page_id)]
    if head is not None:
        fields += [
            ("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(head["page_id"], head["row"])),
            ("WARC-Refers-To-Target-URI", head["url"]), ("Refers-To-Page-ID", head["page_id"]),
        ]
    fields += [
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(block)),
    ]
    return b"WARC/1.1\r\n" + b"".join(_field(*f) for f in fields) + b"\r\n" + block + b"\r\n\r\n"


def dictionary(samples: list[bytes]) -> bytes:
    """A Zstandard dictionary made of sample records; empty where they are too few or too small."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archives(pages: DataFrame, path: str, date: str = DATE) -> None:
    """Writes each row of pages (page_id, url, html) as a WARC record to the archives in path.

    The payload is the html in UTF-8, none for null.  Of records with equal payloads of at least
    LEAST_SHARED bytes the one with the smallest page_id (a missing one before all others; of
    rows with one page_id any one) is a response, the others revisit it and hold no payload;
    smaller payloads are all responses.  A null url or page_id is left out of the record.  An
    empty table gives no records; other columns are left out.

    Each task writes one archive: the dictionary in a leading skippable frame, then one frame for
    each record, by Spark's text sink, which puts an empty skippable frame after each and commits
    only what finished tasks have written.  The dictionary is made of about SAMPLE records chosen
    by a hash, up to SAMPLE_BYTES of each; it bears on the size of the archives only.  Payloads are
    not shuffled as long as the repeated digests can be broadcast (see `small`).
    """
    payload = F.coalesce(pages["html"], F.lit("")).cast("binary")
    held = stage(
        pages.select(
            pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), payload.alias("payload"),
            F.octet_length(payload).cast("long").alias("size"), F.sha2(payload, 256).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "pages",
    )
    heads = small(
        held.where(F.col("size") >= LEAST_SHARED).groupBy("digest")
        .agg(F.min(F.struct("page_id", "row", "url")).alias("head"), F.count("*").alias("n"))
        .where("n > 1").drop("n")
    )
    # Of all rows as many as are wanted, wherever they are; no task hands on more than its share.
    sample = held.where(F.pmod(F.xxhash64("row"), F.lit(max(1, held.count()))) < SAMPLE).select(
        "page_id", "row", "url", F.substring("payload", 1, SAMPLE_BYTES).alias("payload"), "size", "digest"
    ).collect()
    made_of = dictionary([record(*r[:3], bytes(r.payload), *r[4:], None, date) for r in sample])

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(made_of) if made_of else None
        if shared:
            shared.precompute_compress(level=LEVEL)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True)
        frames, size = [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])

        first = bool(made_of)
        for batch in batches:
            for *columns, payload, head in zip(*[
                batch[c] for c in ("page_id", "row", "url", "size", "digest", "payload", "head")
            ]):
                if first:
                    first = False
                    frames.append(DICTIONARY_FRAME.to_bytes(4, "little") + len(made_of).to_bytes(4, "little") + made_of)
                page_id, row, url, n, digest = [c.as_py() for c in columns]
                frames.append(compressor.compress(record(page_id, row, url, payload.as_py(), n, digest, head.as_py(), date)))
                size += len(frames[-1])
                if len(frames) >= BATCH or size >= BATCH_BYTES:
                    yield flush()
                    frames, size = [], 0
        if frames:
            yield flush()

    revisits = F.col("head").isNotNull() & (F.col("head.row") != F.col("row"))
    (
        held.join(heads, "digest", "left")
        .withColumn("head", F.when(revisits, F.col("head")))
        .withColumn("payload", F.when(F.col("head").isNull(), F.col("payload")))
        .mapInArrow(archive, "frame binary")
        .select(F.col("frame").cast("string"))
        .write.option("lineSep", BETWEEN_ROWS).option("compression", "none").text(path)
    )


def frames_of(archive: memoryview) -> Iterator[tuple[int, memoryview]]:
    """The mark and the bytes of each frame: the content of skippable ones, others whole."""
    at = 0
    while at < len(archive):
        mark = int.from_bytes(archive[at : at + 4], "little")
        if mark & ~0xF == SKIPPABLE_FRAME:
            end = at + 8 + int.from_bytes(archive[at + 4 : at + 8], "little")
            yield mark, archive[at + 8 : end]
        else:
            end = at + zstandard.frame_header_size(archive[at : at + 18])
            last = False
            while not last:
                block = int.from_bytes(archive[end : end + 3], "little")
                # A block of kind 1 is one byte that is repeated.
                last, end = bool(block & 1), end + 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
            end += 4 * zstandard.get_frame_parameters(archive[at : at + 18]).has_checksum
            yield mark, archive[at:end]
        at = end


def _parsed(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines if line)


def records_of(archive: memoryview) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """The headers, the HTTP headers and the payload of each record of an archive."""
    decompressor = zstandard.ZstdDecompressor()
    for mark, frame in frames_of(archive):
        if mark == DICTIONARY_FRAME:
            decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(frame)))
        elif mark & ~0xF != SKIPPABLE_FRAME:
            head, block = decompressor.decompress(frame).split(b"\r\n\r\n", 1)
            fields = _parsed(head)
            http, payload = block[: int(fields["Content-Length"])].split(b"\r\n\r\n", 1)
            yield fields, _parsed(http), payload


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives in path, in no order.

    record_id, record_type (response or revisit), page_id, url, payload (null for revisits; left
    out if not payloads), payload_bytes, payload_digest (SHA-256 in hex; both of what was read,
    for a revisit as its headers have them), refers_to (page_id of the record that has the
    payload) and intact (whether size and digest of a payload are as written).  A task reads
    whole archives, as many as fit spark.sql.files.maxPartitionBytes, and unpacks them record by
    record.  A folder without archives gives no rows.
    """
    schema = pa.schema([
        ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
        *([("payload", pa.binary())] if payloads else []),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_()),
    ])

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        for batch in batches:
            for content in batch["content"]:
                for fields, http, payload in records_of(memoryview(content.as_buffer())):
                    n, digest = int(http["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    intact = None
                    if fields["WARC-Type"] == "response":
                        read_n, read_digest = len(payload), hashlib.sha256(payload).hexdigest()
                        intact = (n, digest) == (read_n, read_digest)
                        n, digest = read_n, read_digest
                    else:
                        payload = None
                    rows.append((
                        fields["WARC-Record-ID"], fields["WARC-Type"], number(fields.get("Page-ID")),
                        fields.get("WARC-Target-URI"), *([payload] if payloads else []), n, digest,
                        number(fields.get("Refers-To-Page-ID")), intact,
                    ))
                    size += len(payload or b"") if payloads else 0
                    if len(rows) >= BATCH or size >= BATCH_BYTES:
                        yield flush()
                        rows, size = [], 0
        if rows:
            yield flush()

    ddl = "record_id string, record_type string, page_id long, url string," + (" payload binary," if payloads else "")
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(
        read, f"{ddl} payload_bytes long, payload_digest string, refers_to long, intact boolean"
    )


def oracle_sql() -> str:
    """What the archives of `pages` say of each page, in plain SQL."""
    return (
        "WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),"
        " k AS (SELECT page_id, payload, row_number() OVER same AS place, first_value(page_id) OVER same AS head FROM p"
        " WINDOW same AS (PARTITION BY payload ORDER BY page_id NULLS FIRST)),"
        f" r AS (SELECT *, strlen(payload) >= {LEAST_SHARED} AND place > 1 AS revisits FROM k)"
        " SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest,"
        " CASE WHEN revisits THEN 'revisit' ELSE 'response' END AS record_type,"
        " CASE WHEN revisits THEN head END AS refers_to FROM r"
    )
