"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Archives are plain files: a skippable frame with the dictionary, a frame with the
`warcinfo` record, then a frame per record. Spark's text writer puts them into any file
system it knows: an archive is one row, one row is one file, and the line separator is
an empty skippable frame, which every reader of Zstandard passes over. So a task
that is run again replaces its files by Spark's usual commit.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.llm.common import join_small, keep, shared_folder, without

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGICS = range(0x184D2A50, 0x184D2A60)
ZSTD_MAGIC = 0xFD2FB528
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# A task closes an archive at so many bytes of records before compression.
ARCHIVE_BYTES = 16 << 20

# The dictionary is trained on so many payloads, of so many bytes together, at most.
DICTIONARY_PAGES = 400
DICTIONARY_SAMPLE_BYTES = 8 << 20
DICTIONARY_BYTES = 64 << 10

# Frames are fed to the decoder in steps, so that the rest of the file isn't copied for each.
STEP = 16 << 10

RECORDS = (
    "archive string, offset long, record_type string, record_id string, target_uri string, date string, "
    "payload_digest string, refers_to string, block_bytes long, payload_bytes long, payload binary"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def skippable(magic: int, data: bytes) -> bytes:
    return struct.pack("<II", magic, len(data)) + data


def train_dictionary(pages: DataFrame) -> bytes:
    """From a bounded sample: of `DICTIONARY_PAGES` payloads, chosen by hash of the id, the first 20,971 bytes each.

    Only hashes are sorted, and payloads are cut before they move. Where the sample is too small to be trained on, or has nothing in
    common, its own end is the dictionary, as raw content. Without any payload it is empty.
    """
    hashed = pages.where("length(_payload) BETWEEN 1 AND 1000000").selectExpr("xxhash64(page_id, length(_payload)) AS _h", "_payload")
    chosen = keep(hashed.select("_h").distinct().orderBy("_h").limit(DICTIONARY_PAGES))
    cut = f"substring(_payload, 1, {DICTIONARY_SAMPLE_BYTES // DICTIONARY_PAGES})"
    rows = hashed.join(F.broadcast(chosen), "_h").groupBy("_h").agg(F.expr(f"min({cut}) AS p")).orderBy("_h").collect()
    samples = [bytes(r.p) for r in rows]
    try:
        if len(samples) >= 16 and sum(map(len, samples)) >= 8 * DICTIONARY_BYTES:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # nothing in common
        pass
    own = b"".join(samples)[-DICTIONARY_BYTES:]
    # Content that begins like a trained dictionary would be read as one.
    return own if not own else own.ljust(8, b" ") if own[:4] != struct.pack("<I", 0xEC30A437) else b" " + own


def _clean(value: str) -> str:
    """A header value: control characters would end it, so they are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(kind: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}"]
    lines += [f"{k}: {_clean(v)}" for k, v in headers if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response with its payload, or, with `refers_to`, a revisit that repeats the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = [
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
    ]
    if refers_to is None:
        return record("response", headers, head.encode() + payload)
    headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    return record("revisit", headers, head.encode())


def _archives(dictionary: bytes, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        frame = zstandard.ZstdCompressor(level=3, dict_data=data, write_checksum=True, write_content_size=True).compress
        info = record(
            "warcinfo",
            [("WARC-Record-ID", "<urn:archive>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")],
            b"format: WARC File Format 1.1\r\n",
        )
        start = [skippable(DICTIONARY_MAGIC, dictionary), frame(info)]
        frames, size = list(start), 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(frames)], pa.binary())], ["archive"])

        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(batch.column(i) for i in range(4))):
                raw = page_record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py(), date)
                frames.append(frame(raw))
                size += len(raw)
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    frames, size = list(start), 0
        if size:
            yield closed()

    return write


def write_archives(
    pages: DataFrame, folder: str, least_revisit: int = 0, date: str = "2025-01-01T00:00:00Z"
) -> None:
    """Write a record per row of `pages` (`page_id`, `url`, `html`) into archives under `folder`.

    The payload is `html` in UTF-8, empty for null. Of equal payloads of at least
    `least_revisit` bytes, the row with the smallest id is the response and the
    others are revisits of it; rows that repeat this id are responses too, and rows
    without an id revisit only if the group has an id. A null url leaves its header
    out. Rows are streamed into archives of bounded size.
    """
    rows = without(pages, "_payload", "_digest", "_winner").selectExpr(
        "CAST(page_id AS BIGINT) AS page_id", "url", "coalesce(encode(html, 'UTF-8'), X'') AS _payload"
    )
    digested = rows.selectExpr("*", "unhex(sha1(_payload)) AS _digest")
    repeated = keep(
        digested.where(f"length(_payload) >= {least_revisit}")
        .groupBy("_digest")
        .agg(F.expr("min(page_id) AS _winner"), F.expr("count(*) AS _n"))
        .where("_n > 1 AND _winner IS NOT NULL")
        .drop("_n")
    )
    marked = join_small(digested, repeated, ["_digest"], "left").selectExpr(
        "page_id", "url", "_payload", "IF(page_id <=> _winner, NULL, _winner) AS _refers_to"
    )
    archives = marked.mapInArrow(_archives(train_dictionary(rows), date), "archive binary")
    (
        archives.selectExpr("CAST(archive AS STRING) AS value")
        .write.option("maxRecordsPerFile", 1)
        .option("lineSep", EMPTY_FRAME)
        .text(folder)
    )


class Corrupt(ValueError):
    """An archive that doesn't hold to the formats."""


def _frame(data: memoryview, at: int, decoder: zstandard.ZstdDecompressor, dictionary_id: int) -> tuple[bytes, int]:
    """The content of the frame at `at` and the place after it."""
    try:
        wanted = zstandard.get_frame_parameters(data[at : at + 18])
    except zstandard.ZstdError as error:
        raise Corrupt(f"no frame at {at}: {error}") from None
    if wanted.dict_id and wanted.dict_id != dictionary_id:
        raise Corrupt(f"frame at {at} needs dictionary {wanted.dict_id}, the archive has {dictionary_id}")
    one, parts, pos = decoder.decompressobj(), [], at
    try:
        while not one.eof and pos < len(data):
            parts.append(one.decompress(data[pos : pos + STEP]))
            pos += STEP
    except zstandard.ZstdError as error:
        raise Corrupt(f"frame at {at}: {error}") from None
    if not one.eof:
        raise Corrupt(f"frame at {at} is cut off")
    content = b"".join(parts)
    if wanted.content_size not in (zstandard.CONTENTSIZE_UNKNOWN, len(content)):
        raise Corrupt(f"frame at {at} has {len(content)} bytes, its header says {wanted.content_size}")
    return content, min(pos, len(data)) - len(one.unused_data)


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and content of every data frame; the dictionary comes from the leading skippable frame."""
    view, at = memoryview(data), 0
    decoder, dictionary_id = zstandard.ZstdDecompressor(), 0
    while at < len(view):
        if at + 4 > len(view):
            raise Corrupt(f"{len(view) - at} stray bytes at {at}")
        magic = int.from_bytes(view[at : at + 4], "little")
        if magic not in SKIPPABLE_MAGICS:
            content, end = _frame(view, at, decoder, dictionary_id)
            yield at, content
            at = end
            continue
        size = int.from_bytes(view[at + 4 : at + 8], "little")
        if at + 8 + size > len(view):
            raise Corrupt(f"skippable frame at {at} is cut off")
        if at == 0 and magic == DICTIONARY_MAGIC and size:
            held = bytes(view[8 : 8 + size])
            if int.from_bytes(held[:4], "little") == ZSTD_MAGIC:  # the dictionary may be compressed itself
                held = zstandard.ZstdDecompressor().decompress(held)
            known = zstandard.ZstdCompressionDict(held)
            decoder, dictionary_id = zstandard.ZstdDecompressor(dict_data=known), known.dict_id()
        at += 8 + size


def _fields(lines: list[bytes], at: int) -> dict[str, str]:
    found = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise Corrupt(f"record at {at}: malformed header {line[:80]!r}")
        found[name.decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    return found


def _length(fields: dict[str, str], at: int) -> int:
    text = fields.get("content-length", "")
    if not re.fullmatch(r"[0-9]+", text):
        raise Corrupt(f"record at {at}: bad Content-Length {text!r}")
    return int(text)


def parse_record(data: bytes, at: int) -> tuple:
    """A record's columns from `record_type` on. Headers, lengths and the payload's digest must agree."""
    head, gap, body = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise Corrupt(f"record at {at}: no WARC head")
    fields = _fields(lines[1:], at)
    for name in ("warc-type", "warc-record-id", "warc-date"):
        if not fields.get(name):
            raise Corrupt(f"record at {at}: no {name}")
    length = _length(fields, at)
    if len(body) != length + 4 or body[length:] != b"\r\n\r\n":
        raise Corrupt(f"record at {at}: the block has {len(body) - 4} bytes, Content-Length says {length}")
    kind, block, payload, size = fields["warc-type"], body[:length], None, None
    if kind in ("response", "revisit") and fields.get("content-type", "").startswith("application/http"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        http_lines = http.split(b"\r\n")
        if not gap or not re.match(rb"HTTP/1\.[01] [0-9]{3}", http_lines[0]):
            raise Corrupt(f"record at {at}: no HTTP head")
        size = _length(_fields(http_lines[1:], at), at)
        if kind == "response" and len(payload) != size:
            raise Corrupt(f"record at {at}: the payload has {len(payload)} bytes, its head says {size}")
        if kind == "revisit":
            payload = None
    elif kind in ("response", "resource"):
        payload, size = block, length
    digest = fields.get("warc-payload-digest")
    if payload is not None and digest and digest.startswith("sha1:") and digest[5:] != base32_sha1(payload):
        raise Corrupt(f"record at {at}: the payload isn't that of its digest")
    if kind == "revisit" and not fields.get("warc-refers-to"):
        raise Corrupt(f"record at {at}: a revisit of nothing")
    return (
        kind, fields["warc-record-id"], fields.get("warc-target-uri"), fields["warc-date"],
        digest, fields.get("warc-refers-to"), length, size, payload,
    )


def _reader(with_payload: bool, schema: pa.Schema):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                rows, size = [], 0
                for at, data in frames(content.as_py()):
                    row = parse_record(data, at)
                    rows.append((path.as_py(), at, *(row if with_payload else (*row[:-1], None))))
                    size += len(data) if with_payload else 200
                    if size > ARCHIVE_BYTES:
                        yield _batch(rows, schema)
                        rows, size = [], 0
                yield _batch(rows, schema)

    return read


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Every record of the archives under `folder`, validated: see `RECORDS` for the columns.

    A file is one task's work and is held in its memory, so archives should be of
    bounded size, as `write_archives` makes them. `payload_bytes` of a revisit is the
    length that its HTTP head states. Anything that breaks the formats fails the
    read and says where. An empty folder gives no rows.
    """
    long, text = pa.int64(), pa.string()
    kinds = [text, long, text, text, text, text, text, text, long, long, pa.binary()]
    schema = pa.schema([(x.split()[0], k) for x, k in zip(RECORDS.split(", "), kinds)])
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(_reader(with_payload, schema), RECORDS)


def round_trip(pages: DataFrame, least_revisit: int = 0) -> DataFrame:
    """Write `pages` into archives in the shared folder and read the page records back."""
    folder = shared_folder(pages.sparkSession)
    write_archives(pages, folder, least_revisit)
    return read_archives(pages.sparkSession, folder, with_payload=False).where("record_type IN ('response', 'revisit')")


def page_columns(records: DataFrame) -> DataFrame:
    """`page_id`, `payload_bytes`, `payload_digest`, `record_type`, `refers_to` of page records."""
    number = "CAST(nullif(regexp_extract({}, '^<urn:page:(.*)>$', 1), 'null') AS BIGINT) AS {}"
    return records.selectExpr(
        number.format("record_id", "page_id"),
        "payload_bytes",
        "regexp_replace(payload_digest, '^sha1:', '') AS payload_digest",
        "record_type",
        number.format("refers_to", "refers_to"),
        "archive",
        "offset",
    )
