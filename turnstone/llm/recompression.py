"""Substring deduplication by recompression.

Rounds of local naming.  A symbol's side is a bit of its name; a left symbol followed
by a right one is replaced by a name made of both.  Equal symbols never pair, so a run
stays in place and is named as symbol and repetitions when names are joined.  A name is a hash of
what it stands for, hence the same in every document, block and executor, without a
table of names.  After a round, equal substrings agree but for one symbol at each end:
what an end symbol does depends on its neighbour outside, and all others only on
neighbours inside.

A symbol of round k spans at most 2^k words, so after k rounds two equal windows of w
words share all symbols but 2^k - 1 words at each end.  The shortest chain of symbols
from any shared one that spans at least ``w - 3 (2^k - 1)`` words ends inside; its name
is the high-level symbol that reveals the repeat.  The number of rounds is the largest
for which that is half a window or more.

1. Each block of documents sends the names of its chains, each once, to buckets and
   learns which of them another block holds too.
2. Windows around a shared chain are candidates.  Each block sends the 96-bit digests
   of their words, each once with its smallest document, and learns which of them
   start earlier elsewhere; this verifies each candidate window word for word but for
   collisions of digests.
3. Words covered by a window that is not the first of its kind go.

However often a passage comes, a block sends it once.  Blocks hold the documents
compressed, and only blocks are shuffled beside names and digests.

Earlier is: smaller doc_id (null last), or same id and earlier row, or same row and earlier start.

Cases: null and empty texts have no words; repeated rows and ids are documents of their
own, the later ones repeat the earlier; other columns pass through ``deduplicate`` unread,
whatever their names; an empty table gives an empty result; a long text is one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstone.llm._shared import Ids, Scratch, bucket_count, pack, unpack

BLOCK = 8 << 20
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def join_names(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of a followed by b."""
    x = a * _K[0] + (b ^ b >> np.uint64(31)) * _K[1]
    x ^= x >> np.uint64(29)
    x *= _K[2]
    x ^= x >> np.uint64(32)
    return x


def rounds_for(window: int) -> tuple[int, int]:
    """How many rounds, and the words that a chain spans at least."""
    k = 0
    while window - 3 * (2 ** (k + 1) - 1) >= window / 2:
        k += 1
    return k, window - 3 * (2**k - 1)


def compress(names: np.ndarray, doc_of: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols after the rounds and the word at which each begins."""
    sym, at = names, np.arange(len(names))
    for r in range(rounds):
        right = (sym * _K[3] >> np.uint64(40 + r) & np.uint64(1)).astype(bool)
        pair = np.zeros(len(sym), bool)
        pair[:-1] = ~right[:-1] & right[1:] & (doc_of[at[:-1]] == doc_of[at[1:]])
        joined = sym.copy()
        first = np.flatnonzero(pair)
        joined[first] = join_names(sym[first], sym[first + 1])
        stay = np.ones(len(sym), bool)
        stay[first + 1] = False
        sym, at = joined[stay], at[stay]
    return sym, at


def chains(names: np.ndarray, doc_of: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Name, first word and end of the chain from each symbol; symbols near a document's end have none."""
    rounds, least = rounds_for(window)
    sym, at = compress(names, doc_of, rounds)
    total = len(names)
    end = np.append(at[1:], total)
    own = doc_of[at]
    name, reach = sym * _K[1], end.copy()
    live = np.flatnonzero(end - at < least)
    out = np.ones(len(sym), bool)
    step = 1
    while len(live):
        nxt = live + step
        ok = nxt < len(sym)
        ok[ok] = own[nxt[ok]] == own[live[ok]]
        out[live[~ok]] = False
        live, nxt = live[ok], nxt[ok]
        same = sym[nxt] == sym[nxt - 1]
        name[live] = np.where(same, name[live] * _K[3] + _K[0], join_names(name[live], sym[nxt]))
        reach[live] = end[nxt]
        live = live[reach[live] - at[live] < least]
        step += 1
    return name[out], at[out], reach[out]


class Block:
    """The words of a block's documents, in the documents' order, as names."""

    def __init__(self, batch: pa.RecordBatch, text: str, doc_id: str):
        ids, column = batch.column(doc_id).to_pylist(), batch.column(text)
        self.order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, k))
        self.ids = [ids[k] for k in self.order]
        number, parts, lengths = Ids(), [], []
        for k in self.order:
            words = (column[k].as_py() or "").encode("utf-8", "surrogatepass").split()
            parts.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
            lengths.append(len(words))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
        self.lengths = np.array(lengths, np.int64)
        self.ends = np.cumsum(self.lengths)
        self.names = hashes[np.concatenate(parts)] if parts else np.zeros(0, np.uint64)
        self.doc_of = np.repeat(np.arange(len(lengths), dtype=np.int32), self.lengths)

    def digests(self, places: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """96-bit digests of the windows at these words, in two parts."""
        held = np.zeros(len(self.lengths), bool)
        held[self.doc_of[places]] = True
        own = held[self.doc_of]
        names, places = self.names[own], (np.cumsum(own) - 1)[places]
        out = []
        for start in (names, names * _K[2] ^ names >> np.uint64(17)):
            powers, size = {1: start}, 1
            while 2 * size <= window:
                h = powers[size]
                grown = np.zeros_like(h)
                grown[: len(h) - size] = join_names(h[: len(h) - size], h[size:])
                powers[2 * size] = grown
                size *= 2
            value, at, rest = None, 0, window
            for size in sorted(powers, reverse=True):
                if rest >= size:
                    part = powers[size][places + at]
                    value = part if value is None else join_names(value, part)
                    at, rest = at + size, rest - size
            out.append(value)
        return out[0], (out[1] >> np.uint64(32)).astype(np.uint32)


def first_of_each(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, each one's first place, and every place's number among the distinct ones."""
    order = np.argsort(a, kind="stable")
    new = np.ones(len(a), bool)
    same = a[order[1:]] == a[order[:-1]]
    if (b[order[1:]] != b[order[:-1]])[same].any():
        order = np.lexsort((b, a))
        same = a[order[1:]] == a[order[:-1]]
    new[1:] = ~(same & (b[order[1:]] == b[order[:-1]]))
    first = order[new]
    number = np.empty(len(a), np.int64)
    number[order] = np.cumsum(new) - 1
    return a[first], b[first], first, number


def covered(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """True where one of the spans [begin, end) lies."""
    return np.cumsum(np.bincount(begin, minlength=n + 1)[:n] - np.bincount(end, minlength=n + 1)[:n]) > 0


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (keys >> np.uint64(24)) % np.uint64(n)


def bits(mask: np.ndarray) -> bytes:
    return pack(np.packbits(mask), np.array([len(mask)], np.uint64))


def mask_of(blob: bytes) -> np.ndarray:
    packed, n = unpack(blob)
    return np.unpackbits(packed, count=int(n[0])).astype(bool)


ROWS = "kind string, block long, bucket int, data binary"
REPLIES = "block long, bucket int, data binary"


def _rows(kind: str, block: int, parts: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(parts)), pa.array([block] * len(parts), pa.int64()), pa.array([b for b, _ in parts], pa.int32()), pa.array([d for _, d in parts], pa.binary())], ["kind", "block", "bucket", "data"])


def _dealt(keys: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """Places of sorted keys, by bucket."""
    bucket = bucket_of(keys, n)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order])) + 1
    return [(int(bucket[part[0]]), part) for part in np.split(order, edges) if len(part)]


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _of_ipc(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_all().combine_chunks().to_batches()[0]


def stored_blocks(docs: DataFrame, text: str, limit: int) -> DataFrame:
    """Rows of ``docs`` in blocks: block, data (the rows as compressed Arrow)."""

    def run(batches: Iterator[pa.RecordBatch]):
        task, k, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close():
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays([pa.array([(task << 24) + k], pa.int64()), pa.array([_ipc(batch)], pa.binary())], ["block", "data"])

        for batch in batches:
            sizes = [len(x.as_py() or "") + 64 for x in batch.column(batch.schema.get_field_index(text))]
            start = 0
            for row, n in enumerate(sizes):
                if size and size + n > limit:
                    if row > start:
                        held.append(batch.slice(start, row - start))
                    yield close()
                    held, size, start, k = [], 0, row, k + 1
                size += n
            if len(sizes) > start:
                held.append(batch.slice(start))
        if held:
            yield close()

    return docs.mapInArrow(run, "block long, data binary")


def _joined(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """Each block with the list of its replies (bucket, data)."""
    got = replies.groupBy("block").agg(F.collect_list(F.struct("bucket", F.col("data").alias("reply"))).alias("replies"))
    return blocks.join(got, "block", "left")


def _spread(keys: np.ndarray, n: int, replies: list[dict] | None) -> np.ndarray:
    """The replies' bits at the places of the sorted keys that were sent."""
    out = np.zeros(len(keys), bool)
    places = dict(_dealt(keys, n))
    for r in replies or ():
        out[places[r["bucket"]]] = mask_of(r["reply"])
    return out


def marked(docs: DataFrame, window: int, doc_id: str, text: str, finish, schema) -> DataFrame:
    """Runs the rounds; ``finish(batch, order, removed masks)`` turns each block's rows into result batches."""
    scratch, n = Scratch(docs.sparkSession, "recompression"), bucket_count(docs, text)
    blocks = scratch.save_by(stored_blocks(docs, text, BLOCK), "blocks", "block", n)

    def names(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                b = Block(_of_ipc(batch.column(1)[k].as_py()), text, doc_id)
                keys = np.unique(chains(b.names, b.doc_of, window)[0])
                if len(keys):
                    yield _rows("names", batch.column(0)[k].as_py(), [(at, pack(np.diff(keys[part], prepend=np.uint64(0)))) for at, part in _dealt(keys, n)])

    def shared(rows: pa.Table) -> pa.Table:
        sent = [np.cumsum(unpack(x)[0], dtype=np.uint64) for x in rows["data"].to_pylist()]
        every = np.sort(np.concatenate(sent))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        return pa.table({"block": rows["block"], "bucket": rows["bucket"], "data": pa.array([bits(np.isin(x, twice, assume_unique=True)) for x in sent], pa.binary())})

    found = blocks.mapInArrow(names, ROWS).select("block", "bucket", "data").groupBy("bucket").applyInArrow(shared, REPLIES)

    def candidates(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                block = batch.column(0)[k].as_py()
                b = Block(_of_ipc(batch.column(1)[k].as_py()), text, doc_id)
                name, start, end = chains(b.names, b.doc_of, window)
                keys, inverse, times = np.unique(name, return_inverse=True, return_counts=True)
                hit = ((times > 1) | _spread(keys, n, batch.column(2)[k].as_py()))[inverse.reshape(-1)]
                own = b.doc_of[start[hit]]
                low = np.maximum(end[hit] - window, (b.ends - b.lengths)[own])
                high = np.minimum(start[hit], b.ends[own] - window)
                fits = low <= high
                places = np.flatnonzero(covered(low[fits], high[fits] + 1, len(b.names)))
                if len(places):
                    # Goes through the exchange to a group of its own and comes back as it is.
                    yield _rows("places", block, [(-1 - block % n, pack(np.diff(places, prepend=0).astype(np.uint32)))])
                    a, c, first, _ = first_of_each(*b.digests(places, window))
                    owner = np.array([(1 << 63) - 1 if i is None else i for i in b.ids], np.int64)[b.doc_of[places[first]]]
                    yield _rows("windows", block, [(at, pack(np.diff(a[part], prepend=np.uint64(0)), c[part], owner[part])) for at, part in _dealt(a, n)])

    def earlier(rows: pa.Table) -> pa.Table:
        if rows["bucket"][0].as_py() < 0:
            return rows
        sent = [unpack(x) for x in rows["data"].to_pylist()]
        block = np.repeat(rows["block"].to_numpy(), [len(x[1]) for x in sent])
        a = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in sent])
        c, owner = np.concatenate([x[1] for x in sent]), np.concatenate([x[2] for x in sent])
        order = np.lexsort((block, owner, c, a))
        late = np.zeros(len(a), bool)
        late[order[1:]] = (a[order[1:]] == a[order[:-1]]) & (c[order[1:]] == c[order[:-1]])
        parts = np.split(late, np.cumsum([len(x[1]) for x in sent])[:-1])
        return pa.table({"block": rows["block"], "bucket": rows["bucket"], "data": pa.array([bits(p) for p in parts], pa.binary())})

    tried = _joined(blocks, found).select("block", "data", "replies").mapInArrow(candidates, ROWS)
    replies = tried.select("block", "bucket", "data").groupBy("bucket").applyInArrow(earlier, REPLIES)

    def remove(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                rows = _of_ipc(batch.column(1)[k].as_py())
                b = Block(rows, text, doc_id)
                got = batch.column(2)[k].as_py() or []
                places = next((np.cumsum(unpack(r["reply"])[0], dtype=np.int64) for r in got if r["bucket"] < 0), np.zeros(0, np.int64))
                removed = np.zeros(len(b.names), bool)
                if len(places):
                    a, _, first, number = first_of_each(*b.digests(places, window))
                    repeat = _spread(a, n, [r for r in got if r["bucket"] >= 0])[number]
                    later = np.ones(len(places), bool)
                    later[first] = False
                    gone = places[repeat | later]
                    removed = covered(gone, gone + window, len(b.names))
                masks: list = [None] * len(b.order)
                for place, m in zip(b.order, np.split(removed, b.ends[:-1])):
                    masks[place] = m
                yield from finish(rows, masks)

    return _joined(blocks, replies).select("block", "data", "replies").mapInArrow(remove, schema)


def kept_words(text: str | None, removed: np.ndarray) -> bytes:
    """The words that stay, joined by one space."""
    return b" ".join(w for w, gone in zip((text or "").encode("utf-8", "surrogatepass").split(), removed.tolist()) if not gone)


def removed_spans(removed: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], removed, [False]]).astype(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, spans (removed words, from and to), kept_sha256 of every row of ``docs`` (doc_id, text)."""

    def finish(rows, masks):
        texts = rows.column("text")
        out = [(len(m), int(m.sum()), [{"begin": a, "end": z} for a, z in removed_spans(m)], hashlib.sha256(kept_words(texts[k].as_py(), m)).hexdigest()) for k, m in enumerate(masks)]
        n, gone, spans, sha = zip(*out)
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), pa.array(sha)], ["doc_id", "n_words", "n_removed", "spans", "kept_sha256"])

    return marked(docs.select(F.col("doc_id").cast("long"), "text"), window, "doc_id", "text", finish, "doc_id long, n_words long, n_removed long, spans array<struct<begin: long, end: long>>, kept_sha256 string")


def deduplicate(docs: DataFrame, window: int = 20) -> DataFrame:
    """``docs`` without repeated words: texts that lose some are the rest joined by spaces, those that lose all go."""

    def finish(rows, masks):
        texts, place = rows.column("text"), rows.schema.get_field_index("text")
        new = [texts[k].as_py() if not m.any() else kept_words(texts[k].as_py(), m).decode("utf-8", "surrogatepass") for k, m in enumerate(masks)]
        stay = pa.array([not m.any() or not m.all() for m in masks])
        yield rows.set_column(place, rows.schema.field(place), pa.array(new, rows.schema.field(place).type)).filter(stay)

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    return marked(docs, window, "doc_id", "text", finish, schema)
