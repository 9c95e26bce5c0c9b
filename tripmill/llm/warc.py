"""WARC archives compressed record by record with a dictionary that every archive carries itself.

An archive starts with a skippable Zstandard frame that holds a dictionary built from the archive's own
records; then every record is a frame of its own, compressed with that dictionary. A reader needs nothing
but the file, and can start at the offset of any record.

Records with equal payloads of some length are kept once: the one with the smallest id is a response,
the others are revisit records that refer to it.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.plans.staging import staged

# Fixed values of the formats: the skippable frame of a dictionary, record fields and the revisit profile.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEAST_PAYLOAD = 100  # shorter payloads are never worth a revisit record
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20  # an archive's dictionary is built from its first records, up to so many bytes
ARCHIVE_BYTES = 256 << 20  # compressed; the next record starts another archive
LEVEL = 3
HEAVY_SHARE = 1000  # a payload with more than one in so many rows is matched by broadcast

WRITTEN = "archive string, start bigint, length bigint, record_id string, record_type string"
READ = (
    "archive string, record_id string, page_id string, url string, record_type string, refers_to string, "
    "payload_bytes bigint, payload_digest string, payload binary"
)

ARROW = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}


def record_uri(page: str | None, digest: str) -> str:
    """Identity of a record; ``page_of`` takes the page id out again."""
    return f"<urn:page:{'' if page is None else page.encode().hex()}:{'n' if page is None else 'p'}:{digest[:32]}>"


def page_of(uri: str) -> str | None:
    _, _, page, kind, _ = uri.strip("<>").split(":")
    return None if kind == "n" else bytes.fromhex(page).decode()


def header_value(text: str) -> str:
    """``text`` on one line: control characters and blanks are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _block_of(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *[f"{name}: {value}" for name, value in fields], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> tuple[str, bytes]:
    """Identity and bytes of the record of one page.

    The block is an HTTP answer, whose ``Content-Length`` is that of the full payload; a revisit record
    has its headers only.
    """
    identity = record_uri(page, digest)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", identity), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", header_value(url)))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_uri(refers_to, digest))]
    fields.append(("Content-Type", "application/http; msgtype=response"))
    return identity, _block_of(fields, http if revisit else http + payload)


def dictionary(records: list[bytes]) -> bytes:
    """A Zstandard dictionary of ``records``; where they are too few to train one, their own last bytes."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-DICTIONARY_BYTES:]


class ArchiveWriter:
    """Writes one archive: the dictionary's frame once the first records are there, then a frame a record."""

    def __init__(self, sink, sample_bytes: int = SAMPLE_BYTES):
        self.sink = sink
        self.sample_bytes = sample_bytes
        self.place = 0
        self.waiting: list[tuple[bytes, tuple]] = []
        self.held = 0
        self.compressor = None

    def _write(self, data: bytes) -> None:
        self.sink.write(data)
        self.place += len(data)

    def _start(self) -> None:
        content = dictionary([record for record, _ in self.waiting])
        self.compressor = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(content), write_checksum=True
        )
        small = zstandard.ZstdCompressor(level=LEVEL).compress(content)
        self._write(struct.pack("<II", DICTIONARY_MAGIC, len(small)) + small)

    def _frame(self, record: bytes, about: tuple) -> tuple:
        start, frame = self.place, self.compressor.compress(record)
        self._write(frame)
        return (start, len(frame), *about)

    def add(self, record: bytes, about: tuple) -> list[tuple]:
        """Take a record; returns ``(start, length, *about)`` of the records written by now."""
        if self.compressor:
            return [self._frame(record, about)]
        self.waiting.append((record, about))
        self.held += len(record)
        return self._release() if self.held >= self.sample_bytes else []

    def _release(self) -> list[tuple]:
        self._start()
        written = [self._frame(record, about) for record, about in self.waiting]
        self.waiting = []
        return written

    def close(self) -> list[tuple]:
        written = [] if self.compressor else self._release()
        self.sink.close()
        return written


def open_dictionary(source) -> zstandard.ZstdCompressionDict:
    """The dictionary in the leading frame of an archive, which ``source`` is at the start of."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not start with a dictionary")
    content = source.read(size)
    if content[:4] == ZSTD_MAGIC:
        content = zstandard.ZstdDecompressor().decompress(content)
    return zstandard.ZstdCompressionDict(content)


def _parsed(stream: io.BufferedReader) -> dict | None:
    """Fields and block of the next record, or None at the end."""
    line = stream.readline()
    if not line:
        return None
    if line.rstrip(b"\r\n").decode() != VERSION:
        raise ValueError(f"no record starts with {line[:40]!r}")
    fields = {}
    while line := stream.readline().rstrip(b"\r\n"):
        name, _, value = line.decode().partition(": ")
        fields[name.lower()] = value
    length = int(fields["content-length"])
    fields["block"] = stream.read(length)
    if len(fields["block"]) != length or stream.read(4) != b"\r\n\r\n":
        raise ValueError("the archive ends inside a record")
    return fields


def records_in(source) -> Iterator[dict]:
    """The records of an archive in order, one in memory at a time."""
    decompressor = zstandard.ZstdDecompressor(dict_data=open_dictionary(source))
    stream = io.BufferedReader(decompressor.stream_reader(source, read_across_frames=True), 1 << 16)
    while record := _parsed(stream):
        yield record


def record_at(content: bytes, head: zstandard.ZstdCompressionDict) -> dict:
    """The record of a single frame, as cut out of an archive by its start and length."""
    stream = io.BytesIO(zstandard.ZstdDecompressor(dict_data=head).decompress(content))
    return _parsed(io.BufferedReader(stream))


def page_fields(archive: str, record: dict) -> tuple | None:
    """A row of READ, or None for records of other kinds.

    Size and digest are taken from the payload that was read; for a revisit record, which has none, from
    the headers that it keeps of the full one.
    """
    kind = record["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    head, _, payload = record["block"].partition(b"\r\n\r\n")
    stated = re.search(rb"(?mi)^content-length: (\d+)", head)
    digest = record["warc-payload-digest"].removeprefix("sha256:")
    identity = record["warc-record-id"]
    if kind == "revisit":
        size, payload, refers = int(stated[1]), None, page_of(record["warc-refers-to"])
    else:
        size, refers, found = len(payload), None, hashlib.sha256(payload).hexdigest()
        if found != digest or size != int(stated[1]):
            raise ValueError(f"{archive}: the payload of {identity} is not the one archived")
    return (archive, identity, page_of(identity), record.get("warc-target-uri"), kind, refers, size, digest, payload)


def with_kinds(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, payload, digest, revisit, refers_to`` of every row: what its record will be.

    The smallest id of each repeated digest is found by partial minima. Payloads that more than one in
    ``HEAVY_SHARE`` rows have are at most as many and are matched by broadcast; rows of these, and rows
    with a short payload, get keys of their own, so that the join of all others has no hot key.
    """
    payload = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    digest = F.sha2(payload.cast("binary"), 256)
    keys = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.octet_length(payload).alias("size"), digest.alias("digest"))
    counted = staged(
        keys.where(F.col("size") >= LEAST_PAYLOAD)
        .groupBy("digest")
        .agg(F.min(F.struct(F.col("page_id").isNull().alias("last"), "page_id")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", F.col("first.page_id").alias("first_id"), "n")
    )
    least = F.lit(pages.count() / HEAVY_SHARE)
    heavy = counted.where(F.col("n") > least).select("digest", F.col("first_id").alias("heavy_id"), F.lit(True).alias("is_heavy"))
    light = counted.where(F.col("n") <= least).select(F.col("digest").alias("key"), "first_id", F.lit(True).alias("is_light"))
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload"), digest.alias("digest")
    )
    own_key = F.concat_ws("|", F.xxhash64("page_id", "url").cast("string"), F.monotonically_increasing_id().cast("string"))
    alone = F.col("is_heavy").isNotNull() | (F.octet_length("payload") < LEAST_PAYLOAD)
    matched = (
        rows.join(F.broadcast(heavy), "digest", "left")
        .withColumn("key", F.when(alone, own_key).otherwise(F.col("digest")))
        .join(light, "key", "left")
    )
    repeated = F.col("is_heavy").isNotNull() | F.col("is_light").isNotNull()
    first = F.coalesce("heavy_id", "first_id")
    revisit = repeated & ~F.col("page_id").eqNullSafe(first)
    return matched.select(
        "page_id", "url", "payload", "digest", revisit.alias("revisit"), F.when(revisit, first).alias("refers_to")
    )


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: str | None = None,
    archive_bytes: int = ARCHIVE_BYTES,
    sample_bytes: int = SAMPLE_BYTES,
) -> DataFrame:
    """Archive every row of ``pages`` into ``folder``; returns the index of the records.

    Each task streams its rows into archives of about ``archive_bytes``, holding the first ``sample_bytes``
    of records until the dictionary is built from them. An archive has a name that no other attempt at the
    task uses, and counts only if the index names it: what an attempt that failed left behind is in no
    index. The index (``archive, start, length, record_id, record_type``) is written to the shared folder.
    ``folder`` must be a path or URI that driver and executors share and that pyarrow can open.

    A null html is an empty payload. Null and repeated ids are archived like others; the smallest id does
    not count nulls unless there are no others, and all rows with the smallest id of a payload are
    responses. Long texts are one record each. Characters that a header cannot hold are percent-encoded in
    the URL; a null URL has no header. An empty table makes no archive. Other columns are not read.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    kinds = with_kinds(pages, id_col, url_col, html_col)
    rows = kinds.select(F.col("page_id").cast("string"), "url", "payload", "digest", "revisit", F.col("refers_to").cast("string"))

    schema = pa.schema([(n, ARROW[k]) for n, k in (field.split() for field in WRITTEN.split(", "))])

    def indexed(name: str, written: list[tuple]) -> pa.RecordBatch:
        return _rows([(name, *w) for w in written], schema)

    def write(batches):
        files, base = _filesystem(folder)
        files.create_dir(base, recursive=True)
        name, writer = "", None
        for batch in batches:
            written = []
            for page, url, payload, digest, revisit, refers_to in zip(*batch.columns, strict=True):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    writer = ArchiveWriter(files.open_output_stream(f"{base}/{name}", compression=None), sample_bytes)
                kind = "revisit" if revisit.as_py() else "response"
                identity, record = page_record(
                    page.as_py(), url.as_py(), payload.as_buffer().to_pybytes(), digest.as_py(), refers_to.as_py(), revisit.as_py(), date
                )
                written += writer.add(record, (identity, kind))
                if writer.place >= archive_bytes:
                    written += writer.close()
                    writer = None
                    yield indexed(name, written)
                    written = []
            if written:
                yield indexed(name, written)
        rest = writer.close() if writer is not None else []
        if rest:
            yield indexed(name, rest)

    return staged(rows.mapInArrow(write, WRITTEN))


def read_archives(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Every page record of the archives that ``index`` names, as rows of READ.

    Each archive is streamed by one task; ids come back as text. A payload that does not have the size
    and digest of its record is an error. Without ``with_payload`` it is checked, but not returned. An
    empty index gives no rows.
    """
    names = index.select("archive").distinct()
    schema = pa.schema([(n, ARROW[k]) for n, k in (field.split() for field in READ.split(", "))])

    def read(batches):
        files, base = _filesystem(folder)
        for name in (n for batch in batches for n in batch.column(0).to_pylist()):
            rows, held = [], 0
            with files.open_input_stream(f"{base}/{name}", compression=None) as source:
                for record in records_in(source):
                    row = page_fields(name, record)
                    if row:
                        rows.append(row if with_payload else (*row[:-1], None))
                        held += len(record["block"])
                    if held >= SAMPLE_BYTES:
                        yield _rows(rows, schema)
                        rows, held = [], 0
            if rows:
                yield _rows(rows, schema)

    return names.repartitionByRange(max(1, names.count()), "archive").mapInArrow(read, READ)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
