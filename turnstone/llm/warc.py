"""WARC archives in Zstandard form, written and read back.

An archive begins with a skippable frame that holds its dictionary, itself compressed;
then comes one frame for each record.  The reader loads the dictionary, walks the
frames by their own block headers, decodes one at a time and validates what it finds:
version, mandatory headers, lengths, block and payload digests.

Of records with equal payloads (of at least ``least`` bytes) that with the smallest id
is a response and the others are revisits that refer to it.  The smallest id is taken
by a pre-aggregated minimum for each digest, so a page with very many copies sends a
few partial rows; joined back, a digest's rows are dealt over ``SALTS`` keys, as are
those that no minimum can match.

Archives are rows of a table in the shared folder, bounded in size, which every
executor can write and read; ``content`` is the file as other tools know it.

Cases: null html counts as an empty payload; small payloads are never revisits;
repeated rows give a record each, and all rows with the smallest id are responses; a
null id or url is written as such and comes back null; other columns are ignored; an
empty table gives no archive and an empty result; a payload larger than an archive has
one of its own.
"""

from __future__ import annotations

import hashlib
import re
import struct

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm._shared import Scratch

#: Magic numbers of the format: skippable frames that hold a dictionary, frames, dictionaries.
DICTIONARY_FRAME, FRAME, DICTIONARY = 0x184D2A5D, 0xFD2FB528, b"\x37\xa4\x30\xec"
ARCHIVE_BYTES = 24 << 20
#: Bytes of records that a dictionary is trained on, at the beginning of each archive.
SAMPLE_BYTES, DICTIONARY_BYTES = 1 << 20, 32 << 10
DATE = "1970-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
#: Keys over which the rows of one digest are dealt.
SALTS = 32
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class ArchiveError(ValueError):
    """The archive breaks its format."""


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    m = re.fullmatch(r"<urn:x-page:(none|-?\d+)>", record)
    if not m:
        raise ArchiveError(f"unknown record id {record[:80]}")
    return None if m[1] == "none" else int(m[1])


def write_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    digest = hashlib.sha256(payload).hexdigest()
    block = HTTP % len(payload) + (payload if refers_to is None else b"")
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:x-page:{page_id}"
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE), ("WARC-Target-URI", target)]
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    head += [("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def write_archive(records: list[bytes], level: int = 3) -> bytes:
    sample, size = [], 0
    for r in records:
        if size >= SAMPLE_BYTES:
            break
        sample.append(r[: 64 << 10])
        size += len(sample[-1])
    out, options = [], {}
    try:
        trained = zstandard.train_dictionary(min(DICTIONARY_BYTES, size // 8), sample, level=level)
        frame = zstandard.ZstdCompressor(level=level).compress(trained.as_bytes())
        out.append(struct.pack("<II", DICTIONARY_FRAME, len(frame)) + frame)
        options["dict_data"] = trained
    except (zstandard.ZstdError, ValueError):  # too few records to learn from: an archive without dictionary
        pass
    compress = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True, **options).compress
    return b"".join(out + [compress(r) for r in records])


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame at ``at`` ends, by its header and its blocks' headers."""
    flags = data[at + 4]
    single, checksum = flags >> 5 & 1, flags >> 2 & 1
    at += 5 + (not single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
    while True:
        if at + 3 > len(data):
            raise ArchiveError("a frame is cut short")
        block = data[at] | data[at + 1] << 8 | data[at + 2] << 16
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            break
    at += 4 * checksum
    if at > len(data):
        raise ArchiveError("a frame is cut short")
    return at


def read_frames(content: bytes):
    """(offset, record) of each frame; the leading skippable frame gives the dictionary."""
    data, at, reader = memoryview(content), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        if at + 8 > len(data):
            raise ArchiveError("trailing bytes")
        magic, size = struct.unpack_from("<II", data, at)
        if magic >> 4 == DICTIONARY_FRAME >> 4:
            body = bytes(data[at + 8 : at + 8 + size])
            if len(body) != size:
                raise ArchiveError("a skippable frame is cut short")
            if magic == DICTIONARY_FRAME:
                if at:
                    raise ArchiveError("the dictionary does not lead the archive")
                raw = body if body[:4] == DICTIONARY else zstandard.ZstdDecompressor().decompress(body)
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
            at += 8 + size
            continue
        if magic != FRAME:
            raise ArchiveError("not a frame")
        end = frame_end(data, at)
        yield at, reader.decompress(data[at:end])
        at = end


def headers(raw: bytes, first: bytes) -> dict[str, str]:
    line, *rest = raw.split(b"\r\n")
    if not line.startswith(first):
        raise ArchiveError(f"a record begins with {line[:40]!r}")
    return {k.decode().lower(): v.decode("utf-8", "surrogatepass").strip() for k, v in (x.split(b":", 1) for x in rest if x)}


def read_record(raw: bytes) -> dict:
    """Validates one record; payload is None for a revisit."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    h = headers(head, b"WARC/1.")
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - h.keys()
    if not mark or missing:
        raise ArchiveError(f"a record lacks headers: {sorted(missing)}")
    n = int(h["content-length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ArchiveError("a record's length does not hold")
    if h.get("warc-block-digest") != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ArchiveError("a block's digest does not hold")
    http, mark, payload = block.partition(b"\r\n\r\n")
    length, digest = int(headers(http, b"HTTP/1.")["content-length"]), h["warc-payload-digest"].removeprefix("sha256:")
    kind = h["warc-type"]
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ArchiveError("a payload does not match its headers")
    if kind == "revisit" and (payload or "warc-refers-to" not in h):
        raise ArchiveError("a revisit holds a payload or refers to nothing")
    return {"page_id": page_of(h["warc-record-id"]), "payload_bytes": length, "payload_digest": digest, "record_type": kind, "refers_to": page_of(h["warc-refers-to"]) if kind == "revisit" else None, "url": h.get("warc-target-uri"), "payload": payload if kind == "response" else None}


def write_archives(pages: DataFrame, least: int = 100, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """archive, content: the archives that hold a record for each row of ``pages`` (page_id, url, html)."""
    own = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"))
    own = own.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    first = own.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1").select("digest", "first")
    key, spread = F.when(F.octet_length("payload") >= least, F.col("digest")), F.xxhash64("page_id", "url")
    own = own.select("*", key.alias("key"), F.when(key.isNotNull(), F.pmod(spread, F.lit(SALTS))).otherwise(spread).alias("salt"))
    every = first.select(F.col("digest").alias("key"), "first", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    told = own.join(every, ["key", "salt"], "left").select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))

    def run(batches):
        task, k, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                record = write_record(*(batch.column(c)[row].as_py() for c in range(4)))
                if held and size + len(record) > archive_bytes:
                    yield archive(task, k, held)
                    held, size, k = [], 0, k + 1
                held.append(record)
                size += len(record)
        if held:
            yield archive(task, k, held)

    def archive(task, k, held):
        return pa.RecordBatch.from_arrays([pa.array([f"part-{task:05}-{k:05}.warc.zst"]), pa.array([write_archive(held)], pa.binary())], ["archive", "content"])

    return told.mapInArrow(run, "archive string, content binary")


RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, record_offset long"


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of archives (archive, content), each validated."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                rows = [read_record(r) | {"archive": batch.column(0)[k].as_py(), "record_offset": at} for at, r in read_frames(batch.column(1)[k].as_py())]
                names = [x.split()[0] for x in RECORDS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], pa.string() if s.endswith("string") else pa.int64()) for n, s in zip(names, RECORDS.split(", "))], names)

    return archives.select("archive", "content").mapInArrow(run, RECORDS)


def archived(pages: DataFrame, least: int = 100) -> DataFrame:
    """Writes the archives to the shared folder and reads them back."""
    return read_archives(Scratch(pages.sparkSession, "warc").save(write_archives(pages, least), "archives", "none"))
