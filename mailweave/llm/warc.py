"""WARC archives compressed with a dictionary of their own.

Each task writes the records of its rows to archives of about ``file_bytes`` of payload. An archive
is a leading skippable frame that holds a Zstandard dictionary, built from the records of that very
archive, and then one frame for each record, compressed with the dictionary: any record can be read
alone from its place, and a reader that starts at the front finds all it needs.

Of pages with equal payloads the one with the smallest id is a ``response`` with the page, the
others are ``revisit`` records of the header alone, which name that response. Digests are taken by
Spark; only those that occur twice are joined back, broadcast if measured small, else by a shuffle
in which the digests of many copies are split. The index names the files of the task attempts that
counted, so a lost executor leaves at most an unused file.

Memory: a task holds the records of one archive, ``file_bytes`` and one record more.

Edge cases: a null payload is empty. Payloads under ``SMALLEST`` bytes are responses always. Rows
with the smallest id among equal payloads are all responses. A null id is nobody's original; its
record revisits the one with an id, if there is any. A null address becomes ``about:blank``, bytes
that may not stand in an address are escaped. An archive with too few records for a dictionary has
none, and no leading frame. Extra columns are not read. An empty table writes no file.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from typing import BinaryIO, NamedTuple
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailweave.llm.common import table
from mailweave.llm.token_files import file_system
from mailweave.operators.joins import attach
from mailweave.session import scratch_path, stored

SMALLEST = 100  # bytes of a payload that a revisit may stand for
FILE_BYTES = 64 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 16 << 10  # of each record, spread over it, for the dictionary
LEVEL = 3
# Fixed values of the two formats.
SKIPPABLE = 0x184D2A5D
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"


def record_id(page_id: int | None, digest: str) -> str:
    """An id made of the page's id and the digest's first 46 bits; the id can be read from it."""
    n = (page_id or 0) & (1 << 64) - 1
    low = (n & 0xFFFF) << 46 | int(digest[:12], 16) >> 2
    return str(uuid.UUID(int=n >> 16 << 80 | 8 << 76 | (page_id is None) << 64 | 2 << 62 | low))


def page_of(name: str) -> int | None:
    n = uuid.UUID(name).int
    if n >> 64 & 0xFFF:
        return None
    page = n >> 80 << 16 | n >> 46 & 0xFFFF
    return page - (1 << 64) if page >> 63 else page


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{record_id(page_id, digest)}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote('about:blank' if url is None else url, safe=':/?#[]@!$&*+,;=%~()')}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Type: {HTTP}",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        fields += [f"WARC-Refers-To: <urn:uuid:{record_id(first, digest)}>", f"WARC-Profile: {SAME_PAYLOAD}"]
    return b"".join(["\r\n".join(fields).encode(), b"\r\n\r\n", block, b"\r\n\r\n"])


def info_record(date: str) -> bytes:
    block = b"software: mailweave\r\nformat: WARC File Format 1.1\r\n"
    fields = [
        VERSION, "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {date}",
        "Content-Type: application/warc-fields", f"Content-Length: {len(block)}",
    ]
    return b"".join(["\r\n".join(fields).encode(), b"\r\n\r\n", block, b"\r\n\r\n"])


def sample(record: bytes) -> bytes:
    """The record, or four even stretches of a long one."""
    if len(record) <= SAMPLE_BYTES:
        return record
    part, step = SAMPLE_BYTES // 4, (len(record) - SAMPLE_BYTES // 4) // 3
    return b"".join(record[k * step : k * step + part] for k in range(4))


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of all records of an archive; ``None`` where they are too few for one."""
    samples = [sample(r) for r in records]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    if len(samples) < 8 or size < 1024:
        return None
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8, f=20, accel=4, level=LEVEL)
    except zstandard.ZstdError:  # too uniform to learn from
        return None


def write_archive(path: str, records: list[bytes], date: str) -> list[tuple[int, int]]:
    """Writes the records to one archive; returns the place and length of each one's frame."""
    known = build_dictionary(records)
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True, write_content_size=True)
    store, at = file_system(path)
    store.create_dir(at.rsplit("/", 1)[0], recursive=True)
    places, place = [], 0
    with store.open_output_stream(at + ".writing") as out:
        if known is not None:
            held = known.as_bytes()
            place += out.write(struct.pack("<II", SKIPPABLE, len(held)) + held)
        place += out.write(press.compress(info_record(date)))
        for record in records:
            frame = press.compress(record)
            out.write(frame)
            places.append((place, len(frame)))
            place += len(frame)
    store.move(at + ".writing", at)
    return places


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


def next_record(stream: BinaryIO) -> Record | None:
    """The next record of a decompressed archive."""
    line = stream.readline()
    if not line:
        return None
    if line.strip() != VERSION.encode():
        raise ValueError(f"no record starts with {line[:40]!r}")
    headers = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().partition(":")
        headers[name.strip().lower()] = value.strip()
    length = int(headers["content-length"])
    block = stream.read(length)
    if len(block) != length or stream.read(4) != b"\r\n\r\n":
        raise ValueError("a record ends too early")
    return Record(headers, block)


def read_dictionary(source: BinaryIO) -> zstandard.ZstdCompressionDict | None:
    """The dictionary in the leading frame; the source is left behind it."""
    head = source.read(8)
    magic, length = struct.unpack("<II", head) if len(head) == 8 else (0, 0)
    if magic != SKIPPABLE:
        source.seek(0)
        return None
    return zstandard.ZstdCompressionDict(source.read(length))


def read_archive(path: str) -> Iterator[Record]:
    """All records of an archive, front to back."""
    import io

    store, at = file_system(path)
    with store.open_input_file(at) as source:
        open_frame = zstandard.ZstdDecompressor(dict_data=read_dictionary(source))
        with open_frame.stream_reader(source, read_across_frames=True, closefd=False) as plain:
            stream = io.BufferedReader(plain, 1 << 16)
            while (record := next_record(stream)) is not None:
                yield record


def read_one(path: str, place: int, length: int) -> Record:
    """The record at one place."""
    import io

    store, at = file_system(path)
    with store.open_input_file(at) as source:
        open_frame = zstandard.ZstdDecompressor(dict_data=read_dictionary(source))
        source.seek(place)
        return next_record(io.BytesIO(open_frame.decompress(source.read(length))))


def mark_revisits(df: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """``(page_id, url, payload, digest, first, revisit)``."""
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    rows = df.select(
        F.col(f"`{key}`").cast("bigint").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.octet_length("payload") >= SMALLEST)
    copied = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    copied = stored(copied.filter("n > 1 AND first IS NOT NULL").select("digest", "first"), "copied_pages")
    marked = attach(rows, copied, ["digest"], ["page_id"])
    revisit = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    return marked.select("page_id", "url", "payload", "digest", "first", revisit.alias("revisit"))


def write_warc(
    df: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    file_bytes: int = FILE_BYTES,
    date: str | None = None,
) -> DataFrame:
    """Write the archives below ``path``; returns the stored index ``(page_id, file, place, length)``."""
    when = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    run = uuid.uuid4().hex[:8]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"{path.rstrip('/')}/part-{task.partitionId():06d}-{run}-{task.taskAttemptId()}"
        keys, records, held, files = [], [], 0, 0

        def finish() -> pa.RecordBatch:
            nonlocal files, held
            file = f"{name}-{files:04d}.warc.zst"
            places = write_archive(file, records, when)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()), pa.array([file] * len(keys), pa.string()),
                    pa.array([p for p, _ in places], pa.int64()), pa.array([n for _, n in places], pa.int64()),
                ],
                names=["page_id", "file", "place", "length"],
            )
            files, held = files + 1, 0
            keys.clear()
            records.clear()
            return out

        for batch in batches:
            for page_id, url, payload, digest, first, revisit in zip(*[c.to_pylist() for c in batch.columns]):
                records.append(page_record(page_id, url, payload, digest, first, revisit, when))
                keys.append(page_id)
                held += len(records[-1])
                if held >= file_bytes:
                    yield finish()
        if records:
            yield finish()

    rows = mark_revisits(df, key, url, payload)
    return stored(rows.mapInArrow(write, "page_id bigint, file string, place bigint, length bigint"), "warc_index")


SCHEMA = "file string, page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint"


def page_row(record: Record) -> tuple:
    """What a response or revisit says; the payload of a response is digested and compared."""
    h = record.headers
    name = lambda field: page_of(h[field].removeprefix("<urn:uuid:").removesuffix(">")) if field in h else None
    http, _, payload = record.block.partition(b"\r\n\r\n")
    size = int(http.lower().rpartition(b"content-length:")[2].split(b"\r\n")[0])
    digest = h["warc-payload-digest"].removeprefix("sha256:")
    if h["warc-type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {h['warc-record-id']} is damaged")
    return name("warc-record-id"), h["warc-target-uri"], h["warc-type"], size, digest, name("warc-refers-to"), payload


def read_warc(files: DataFrame, payloads: bool = False) -> DataFrame:
    """A row for each page record of the archives named in ``files(file)``; with ``payloads`` also
    the column ``payload``, null for revisits. An archive is read by one task, front to back."""
    names = files.select("file").distinct()
    # A task per archive: some hundred bytes name many megabytes.
    count = max(1, names.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            file, page, url, kind, size, digest, refers, body = zip(*rows)
            columns = [
                pa.array(file, pa.string()), pa.array(page, pa.int64()), pa.array(url, pa.string()), pa.array(kind, pa.string()),
                pa.array(size, pa.int64()), pa.array(digest, pa.string()), pa.array(refers, pa.int64()),
            ]
            fields = ["file", "page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"]
            if payloads:
                columns.append(pa.array(body, pa.binary()))
                fields.append("payload")
            return pa.RecordBatch.from_arrays(columns, names=fields)

        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows, held = [], 0
                for record in read_archive(file):
                    if record.headers["warc-type"] == "warcinfo":
                        continue
                    *row, body = page_row(record)
                    keep = payloads and row[2] == "response"
                    rows.append((file, *row, body if keep else None))
                    held += len(body) if keep else 200
                    if held >= 8 << 20:
                        yield out(rows)
                        rows, held = [], 0
                if rows:
                    yield out(rows)

    return names.repartition(count).mapInArrow(read, SCHEMA + (", payload binary" if payloads else ""))


def op13_warc(spark, sf_dir) -> DataFrame:
    index = write_warc(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_warc(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p),
r AS (SELECT *, payload_bytes >= 100 AND first IS NOT NULL AND coalesce(page_id > first, true) AS revisit FROM f)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN revisit THEN first END AS refers_to FROM r"""
