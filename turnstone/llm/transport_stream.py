"""Media columns: MPEG transport streams.

``write_stream`` stores a payload as one programme of 8-bit samples: program
tables with their checksums, then one elementary packet for each access unit, cut
into 188-byte packets with continuity counters, timestamps (90 kHz) and
random-access marks.  ``read_stream`` takes any such bytes apart again: it follows
the association table to the map table and to the stream, checks sync bytes,
checksums and counters, joins the elementary packets and keeps timestamps and
random-access points.

A packet sent twice, as the format allows, is read once.  Where a counter jumps and no
discontinuity is announced, packets were lost: the jump is counted, the elementary
packet that lacks them goes, and reading goes on at the next one.  A table's section is
read from where one begins; one whose checksum fails is passed over for a later one.
``decode_streams`` puts what makes a stream unreadable into its ``error`` column.

Cases: null text counts as empty, whose payload is one access unit of filling; long
texts are stored whole; repeated rows give equal values; a null id stays null; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from turnstone.llm._shared import Scratch, texts

PACKET, SYNC, PAT_PID = 188, 0x47, 0
#: Of the streams written here: 8-bit samples at 48 kHz as a private stream.
PMT_PID, DATA_PID, PROGRAM, PRIVATE_STREAM, STREAM_ID = 0x1000, 0x0100, 1, 0x06, 0xBD
UNIT, CLOCK, RATE = 576, 90_000, 48_000
TICKS = UNIT * CLOCK // RATE
#: Access units from one random-access point to the next.
RANDOM_ACCESS_EVERY = 16
FILL = 0xFF


def _crc_table() -> list[int]:
    out = []
    for byte in range(256):
        crc = byte << 24
        for _ in range(8):
            crc = (crc << 1 ^ 0x04C11DB7 if crc >> 31 else crc << 1) & 0xFFFFFFFF
        out.append(crc)
    return out


_CRC = _crc_table()


def section_crc(data: bytes) -> int:
    """The tables' checksum: polynomial 04C11DB7, most significant bit first, no final inversion."""
    crc = 0xFFFFFFFF
    for byte in data:
        crc = (crc << 8 & 0xFFFFFFFF) ^ _CRC[crc >> 24 ^ byte]
    return crc


def _section(table: int, number: int, body: bytes) -> bytes:
    head = struct.pack(">BHHBBB", table, 0xB000 | len(body) + 9, number, 0xC1, 0, 0)
    return head + body + struct.pack(">I", section_crc(head + body))


def _table_packet(pid: int, section: bytes) -> bytes:
    return (struct.pack(">BHB", SYNC, 0x4000 | pid, 0x10) + b"\0" + section).ljust(PACKET, b"\xff")


PAT = _table_packet(PAT_PID, _section(0, 1, struct.pack(">HH", PROGRAM, 0xE000 | PMT_PID)))
PMT = _table_packet(PMT_PID, _section(2, PROGRAM, struct.pack(">HH", 0xE000 | DATA_PID, 0xF000) + struct.pack(">BHH", PRIVATE_STREAM, 0xE000 | DATA_PID, 0xF000)))


def pad(payload: bytes, unit: int = UNIT) -> bytes:
    """Filled up to a positive multiple of the unit."""
    return payload + bytes([FILL]) * (unit - len(payload) % unit if len(payload) % unit or not payload else 0)


def write_stream(payload: bytes) -> bytes:
    """One transport stream; the payload's length is a multiple of the access unit."""
    units = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
    n = len(units)
    # An elementary packet is a 14-byte head and one unit: three full packets and a stuffed one, of which the first has a 2-byte adaptation field.
    head, room, per = 14, PACKET - 4, 4
    pes = np.empty((n, head + UNIT), np.uint8)
    pes[:, :9] = np.frombuffer(struct.pack(">3sBHBBB", b"\0\0\1", STREAM_ID, head - 6 + UNIT, 0x84, 0x80, 5), np.uint8)
    pts = np.arange(n, dtype=np.int64) * TICKS & (1 << 33) - 1
    pes[:, 9] = 0x21 | pts >> 29 & 0x0E
    pes[:, 10] = pts >> 22 & 0xFF
    pes[:, 11] = 1 | pts >> 14 & 0xFE
    pes[:, 12] = pts >> 7 & 0xFF
    pes[:, 13] = 1 | pts << 1 & 0xFE
    pes[:, 14:] = units
    out = np.full((n, per, PACKET), 0xFF, np.uint8)
    out[:, :, 0] = SYNC
    out[:, :, 1] = DATA_PID >> 8
    out[:, 0, 1] |= 0x40
    out[:, :, 2] = DATA_PID & 0xFF
    out[:, :, 3] = 0x10 | np.arange(n * per).reshape(n, per) & 15
    first = room - 2
    out[:, 0, 3] |= 0x20
    out[:, 0, 4] = 1
    out[:, 0, 5] = np.where(np.arange(n) % RANDOM_ACCESS_EVERY, 0x00, 0x40)
    out[:, 0, 6:] = pes[:, :first]
    out[:, 1, 4:] = pes[:, first : first + room]
    out[:, 2, 4:] = pes[:, first + room : first + 2 * room]
    rest = head + UNIT - first - 2 * room
    stuff = room - rest
    out[:, 3, 3] |= 0x20
    out[:, 3, 4] = stuff - 1
    out[:, 3, 5] = 0
    out[:, 3, 4 + stuff :] = pes[:, head + UNIT - rest :]
    return PAT + PMT + out.tobytes()


class StreamError(ValueError):
    """The bytes break the format."""


@dataclass
class Stream:
    """What a transport stream held.  ``timestamps`` has one value for each elementary packet, -1 without one."""

    programs: dict[int, int]
    stream_type: int
    pid: int
    payload: bytes
    timestamps: np.ndarray
    random_access: np.ndarray
    unit_bytes: np.ndarray
    packets: int
    duplicates: int
    continuity_errors: int
    damaged: int


def _section_of(p: np.ndarray, own: np.ndarray, start: np.ndarray, first: np.ndarray) -> bytes:
    """The first whole section among a table's packets whose checksum holds."""
    raw, failed = None, False
    for k in own.tolist():
        body = p[k, start[k] :].tobytes()
        if first[k] and body:
            # What comes before the pointer's place ends the section before.
            held, raw = None if raw is None else raw + body[1 : 1 + body[0]], body[1 + body[0] :]
        else:
            held, raw = (None, None) if raw is None else (raw + body, raw + body)
        for tried in (held, raw):
            if tried is not None and len(tried) >= 3 and len(tried) >= (need := 3 + (tried[1] << 8 & 0xF00 | tried[2])):
                if need >= 12 and not section_crc(tried[:need]):
                    return tried[:need]
                failed = True
                if tried is raw:
                    raw = None
    raise StreamError("a table's checksum does not hold" if failed else "a table does not end")


def read_stream(data: bytes) -> Stream:
    """Parses tables, counters and elementary packets of the first programme's first stream."""
    if not data or len(data) % PACKET:
        raise StreamError("not whole packets")
    p = np.frombuffer(data, np.uint8).reshape(-1, PACKET)
    if (p[:, 0] != SYNC).any() or (p[:, 1] & 0x80).any():
        raise StreamError("a packet lacks its sync byte or is marked as broken")
    pid = (p[:, 1].astype(np.uint16) & 0x1F) << 8 | p[:, 2]
    first, control, counter = (p[:, 1] & 0x40) > 0, p[:, 3] >> 4 & 3, p[:, 3] & 15
    start = np.where(control & 2, 5 + p[:, 4].astype(np.int64), 4)
    start = np.where(control & 1, start, PACKET)
    if (start > PACKET).any():
        raise StreamError("an adaptation field is too long")

    def table(number: int) -> bytes:
        own = pid == number
        if not own.any():
            raise StreamError("a table is missing")
        return _section_of(p, np.flatnonzero(own), start, first)

    pat = table(PAT_PID)
    programs = {n: m & 0x1FFF for n, m in struct.iter_unpack(">HH", pat[8:-4]) if n}
    if not programs:
        raise StreamError("no programme")
    pmt = table(next(iter(programs.values())))
    at = 12 + (pmt[10] << 8 & 0xF00 | pmt[11])
    stream_type, number = pmt[at], (pmt[at + 1] << 8 | pmt[at + 2]) & 0x1FFF
    own = np.flatnonzero(pid == number)
    carrying = own[(control[own] & 1) > 0]
    again = np.zeros(len(carrying), bool)
    same = np.flatnonzero(counter[carrying[1:]] == counter[carrying[:-1]]) + 1
    # Clock references aside, which lie before the payload, a packet sent twice is the same.
    alike = [start[a] == start[b] and bool((p[a, start[a] :] == p[b, start[b] :]).all()) for a, b in zip(carrying[same], carrying[same - 1])]
    again[same[np.array(alike, bool)]] = True
    thrice = int((again[1:] & again[:-1]).sum())
    duplicates, carrying = int(again.sum()), carrying[~again]
    flags = np.where((control[carrying] & 2 > 0) & (p[carrying, 4] > 0), p[carrying, 5], 0)
    jump = np.zeros(len(carrying), bool)
    jump[1:] = (np.diff(counter[carrying].astype(np.int16)) % 16 != 1) & (flags[1:] & 0x80 == 0)
    wrong = int(jump.sum()) + thrice
    if not first[carrying].any():
        raise StreamError("no elementary packet begins")
    lead = int(np.argmax(first[carrying]))
    carrying, flags, jump = carrying[lead:], flags[lead:], jump[lead:]
    opens = np.flatnonzero(first[carrying])
    inner = jump & ~first[carrying]
    torn = np.add.reduceat(inner, opens) > 0
    cut = np.append(jump[opens[1:]], False)
    mark = flags & 0x40 > 0
    held = (PACKET - start[carrying]).astype(np.int64)
    body = p[carrying][np.arange(PACKET) >= start[carrying][:, None]]
    ends = np.cumsum(held)
    begins = (ends - held)[opens]
    stops = np.append(begins[1:], ends[-1])
    heads = body[np.minimum(begins[:, None] + np.arange(9), len(body) - 1)].astype(np.int64)
    length = heads[:, 4] << 8 | heads[:, 5]
    whole = (stops - begins >= 9) & (heads[:, :3] == [0, 0, 1]).all(axis=1) & ~torn
    whole &= np.where(length > 0, length + 6 == stops - begins, ~cut) & (9 + heads[:, 8] <= stops - begins)
    damaged = int((~whole).sum()) + (lead > 0)
    if not whole.any():
        raise StreamError("no elementary packet is whole")
    heads, begins, stops, opens = heads[whole], begins[whole], stops[whole], opens[whole]
    has = (heads[:, 7] & 0x80 > 0) & (heads[:, 8] >= 5)
    t = body[np.minimum(begins[:, None] + np.arange(9, 14), len(body) - 1)].astype(np.int64)
    pts = (t[:, 0] >> 1 & 7) << 30 | t[:, 1] << 22 | t[:, 2] >> 1 << 15 | t[:, 3] << 7 | t[:, 4] >> 1
    skip = 9 + heads[:, 8]
    edge = np.zeros(len(body) + 1, np.int32)
    np.add.at(edge, begins + skip, 1)
    np.subtract.at(edge, stops, 1)
    payload = body[np.cumsum(edge[:-1]) > 0].tobytes()
    return Stream(programs, int(stream_type), int(number), payload, np.where(has, pts, -1), np.flatnonzero(mark[opens]), stops - begins - skip, len(p), duplicates, wrong, damaged)


STREAMS = "doc_id long, n_bytes long, media binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string"


def encode_streams(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the stream that stores each text of ``docs`` (doc_id, text)."""

    def run(batches):
        for doc_id, text in texts(batches):
            raw = (text or "").encode("utf-8", "surrogatepass")
            yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([len(raw)], pa.int64()), pa.array([write_stream(pad(raw))], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(merged(run), STREAMS)


def merged(run, limit: int = 8 << 20):
    """Joins the one-row batches that ``run`` gives, up to ``limit`` bytes."""

    def wrapped(batches):
        held, total = [], 0
        for batch in run(batches):
            held.append(batch)
            total += batch.nbytes
            if total > limit or len(held) >= 5_000:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, total = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return wrapped


def feature_of(s: Stream) -> str:
    """Units, packets, first and last timestamp, random-access points with their timestamps' sum, what was lost, and the samples' peak and power."""
    level = np.abs(np.frombuffer(s.payload, np.uint8).astype(np.int16) - 128)
    peak, power = (int(level.max()), int(np.square(level, dtype=np.int64).sum()) // len(level)) if len(level) else (0, 0)
    return f"units={len(s.timestamps)};packets={s.packets};type={s.stream_type};pts={s.timestamps[0]}-{s.timestamps[-1]};random_access={len(s.random_access)};random_access_pts={int(s.timestamps[s.random_access].sum())};counter_errors={s.continuity_errors};damaged={s.damaged};peak={peak};power={power}"


def stored(docs: DataFrame) -> DataFrame:
    """The streams of all texts, written to the shared folder and read from there."""
    return Scratch(docs.sparkSession, "transport-streams").save(encode_streams(docs), "media")


def decode_streams(media: DataFrame) -> DataFrame:
    """Reads streams back; digests are of the payload read from them.  An unreadable stream has an error and no payload."""

    def run(batches):
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                data = batch.column(2)[k].as_py()
                try:
                    s = read_stream(data)
                    read = (len(s.payload), hashlib.sha256(s.payload).hexdigest(), zlib.crc32(s.payload[-32:])), feature_of(s), None
                except StreamError as fault:
                    read = (None, None, None), None, str(fault)
                rows.append((batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), *read[0], len(data), hashlib.sha256(data).hexdigest(), *read[1:]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()))], FEATURES.replace(" long", "").replace(" string", "").split(", "))

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, FEATURES)
