"""Things the operators share: the scratch folder, packed arrays, block dictionaries.

Scratch tables
    Lineage is cut by writing Parquet below ``spark.checkpoint.dir`` (shared by
    driver and executors) and reading it again.  A lost executor then costs the
    tasks it ran, never a table.

Block dictionaries
    Several operators need "look every token of every document up in a
    corpus-wide table".  Shuffling one row for each (document, token) moves more
    bytes than the input has.  Instead documents are read in blocks of bounded
    size; a block sends each distinct token once, to the bucket its hash names,
    and gets one value for each back.  Rows are packed arrays, so the JVM moves
    few large rows.  A token that every document holds arrives at its bucket
    once from each block, however often it occurs: no key can outgrow the number
    of blocks.
"""

from __future__ import annotations

import gc
import struct
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text gathered before a block is closed; one longer text is a block of its own.
BLOCK_BYTES = 16 << 20
#: Bytes of stored input for which one more bucket is opened.
BUCKET_BYTES = 4 << 20
MIN_BUCKETS = 48
#: Names of rows (8 bytes) that are broadcast at most; more are merged.
BROADCAST_ROWS = 1_000_000


def shared_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where it is unset, a temporary one, on a local master only."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="turnstone-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


class Scratch:
    """Tables written below the shared folder; ``drop`` removes those no later step reads."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.option("compression", compression).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_by(self, df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
        """A table bucketed by ``key``, whose rows are large and compressed: joins on it move only the other side."""
        table = f"turnstone_{uuid.uuid4().hex}"
        df.write.option("compression", "none").option("path", f"{self.base}/{name}").bucketBy(min(buckets, 50_000), key).saveAsTable(table)
        out = self.spark.table(table)
        # The relation is resolved by now; the files are not the catalog's.
        self.spark.sql(f"DROP TABLE {table}")
        return out

    def save_parts(self, df: DataFrame, name: str, kind: str, kinds: list[str], key: str, buckets: int) -> list[DataFrame]:
        """As ``save_by``, the rows of each kind as a table of its own (``name/kind=...``), which ``drop`` can remove alone."""
        table, path = f"turnstone_{uuid.uuid4().hex}", f"{self.base}/{name}"
        buckets, out = min(buckets, 50_000), []
        df.write.option("compression", "none").option("path", path).partitionBy(kind).bucketBy(buckets, key).saveAsTable(table)
        self.spark.sql(f"DROP TABLE {table}")
        columns = df.drop(kind)._jdf.schema().toDDL()
        for k in kinds:
            place = f"{path}/{kind}={k}".replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({key}) INTO {buckets} BUCKETS LOCATION '{place}'")
            out.append(self.spark.table(table))
            self.spark.sql(f"DROP TABLE {table}")
        return out

    def release(self) -> None:
        """Shuffle files of steps that are done go now; they stay until the driver happens to collect its garbage otherwise."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Estimates beyond this are Catalyst's way to say that a plan's size is not known.
UNKNOWN_BYTES = 1 << 50


def stored_bytes(df: DataFrame, text: str = "text") -> int:
    """The size of the files that a plan scans, without reading them; else its texts are added up."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < UNKNOWN_BYTES else df.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0


def bucket_count(df: DataFrame, text: str = "text") -> int:
    """Buckets in proportion to the input, so that one bucket's share stays small at every size."""
    return max(MIN_BUCKETS, stored_bytes(df, text) // BUCKET_BYTES)


def held_back(df: DataFrame, keep: list[str], computed: dict[str, Column]) -> DataFrame:
    """Columns ``keep`` and ``computed``, the latter through a generator of one row.

    The optimizer pushes no filter below a generator whose output it mentions, so later
    conditions read the computed columns instead of repeating their expressions.
    """
    row = F.explode(F.array(F.struct(*[c.alias(n) for n, c in computed.items()]))).alias("_q_computed")
    return df.select(*[F.col(f"`{c}`") for c in keep], row).select(*[F.col(f"`{c}`") for c in keep], "_q_computed.*")


# --- packed arrays ---------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; bytes of equal rank lie together, which small integers need."""
    head = [struct.pack("<I", len(arrays))]
    body = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        kind = a.dtype.str.encode()
        planes = a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes() if len(a) else b""
        head.append(struct.pack("<4sQ", kind, len(a)))
        body.append(planes)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(head + body))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    (n,) = struct.unpack_from("<I", raw)
    at = 4 + 12 * n
    out = []
    for i in range(n):
        kind, size = struct.unpack_from("<4sQ", raw, 4 + 12 * i)
        dtype = np.dtype(kind.rstrip(b"\0").decode())
        end = at + size * dtype.itemsize
        planes = np.frombuffer(raw, np.uint8, end - at, at)
        out.append(np.ascontiguousarray(planes.reshape(dtype.itemsize, size).T).view(dtype).reshape(-1) if size else np.zeros(0, dtype))
        at = end
    return out


def pack_words(words: list[bytes], *more: np.ndarray) -> bytes:
    return pack(np.fromiter(map(len, words), np.uint32, len(words)), np.frombuffer(b"".join(words), np.uint8), *more)


def unpack_words(blob: bytes) -> tuple[list[bytes], list[np.ndarray]]:
    lengths, data, *more = unpack(blob)
    raw, ends = data.tobytes(), np.cumsum(lengths, dtype=np.int64).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)], more


def deltas(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Differences within runs that are sorted; a run's first value stays."""
    out = ids.astype(np.int64)
    out[1:] -= ids[:-1]
    keep = starts[starts < len(ids)]
    out[keep] = ids[keep]
    return out.astype(np.uint32)


def undeltas(diff: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    total = np.cumsum(diff, dtype=np.int64)
    before = np.concatenate([[0], total])[starts]
    return total - np.repeat(before, lengths)


# --- blocks ----------------------------------------------------------------


def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str | None]]:
    """(doc_id, text) of each row of batches whose first two columns are these."""
    for batch in batches:
        ids, values = batch.column(0).to_pylist(), batch.column(1)
        for k, i in enumerate(ids):
            yield i, values[k].as_py()


def blocks(rows: Iterator[tuple], size: Callable[[tuple], int], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[tuple]]]:
    """(block id, rows) of at most ``limit`` bytes, or one row.  The id holds the task's number and a counter."""
    task, held, total, k = TaskContext.get().partitionId(), [], 0, 0
    for row in rows:
        n = size(row)
        if held and total + n > limit:
            yield (task << 24) + k, held
            held, total, k = [], 0, k + 1
        held.append(row)
        total += n
    if held:
        yield (task << 24) + k, held


class Ids(dict):
    """Numbers keys in the order in which they first come."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def nullable(ids: list) -> tuple[np.ndarray, np.ndarray]:
    """Document ids as numbers and a mask of those that are null."""
    mask = np.fromiter((x is None for x in ids), np.bool_, len(ids))
    return np.fromiter((0 if x is None else x for x in ids), np.int64, len(ids)), mask


def by_bucket(words: list[bytes], n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each word's bucket, the words' order by bucket, and where buckets begin in that order."""
    crc = zlib.crc32
    bucket = np.fromiter((crc(w) for w in words), np.uint32, len(words)) % np.uint32(n_buckets)
    order = np.argsort(bucket, kind="stable")
    return bucket, order, np.concatenate([[0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(words)]]).astype(np.int64)


TABLE = "kind string, block long, bucket int, data binary"


def dictionary_table(docs: DataFrame, tokenize: Callable, n_buckets: int, counted: Callable | None = None) -> DataFrame:
    """Rows 'docs' (a block's documents and their token frequencies) and 'words' (a block's distinct tokens of one bucket).

    ``tokenize(text)`` gives a list of bytes or str keys and a tuple of numbers kept for
    the document.  With ``counted(doc_id)``, word rows also carry how often the
    documents for which it is true hold each word.
    """

    def run(batches):
        for block, rows in blocks(texts(batches), lambda r: 64 + len(r[1] or "")):
            ids, per, uniq, freq, kept = Ids(), [], [], [], []
            number, occurrences = ids.__getitem__, [np.zeros(0, np.int64)]
            for doc_id, text in rows:
                tokens, numbers = tokenize(text)
                found, times = np.unique(np.fromiter(map(number, tokens), np.int64, len(tokens)), return_counts=True)
                uniq.append(found)
                freq.append(times)
                per.append(len(found))
                kept.append(numbers)
                if counted is not None and doc_id is not None and counted(doc_id):
                    occurrences.append(np.stack([found, times]).reshape(-1))
            words = [w if isinstance(w, bytes) else w.encode("utf-8", "surrogatepass") for w in ids]
            lengths = np.array(per, np.int64)
            starts = np.cumsum(lengths) - lengths
            flat = np.concatenate(uniq) if uniq else np.zeros(0, np.int64)
            bucket, order, bounds = by_bucket(words, n_buckets)
            number, mask = nullable([r[0] for r in rows])
            columns = [np.array(c, np.int64) for c in zip(*kept)]
            data = pack(number, mask, lengths.astype(np.uint32), deltas(flat, starts), np.concatenate(freq).astype(np.uint32), bucket, *columns)
            yield pa.RecordBatch.from_pydict({"kind": ["docs"], "block": [block], "bucket": pa.array([-1], pa.int32()), "data": pa.array([data], pa.binary())})
            counts = np.zeros(len(words), np.uint32)
            for pair in occurrences[1:]:
                found, times = pair.reshape(2, -1)
                counts[found] += times.astype(np.uint32)
            out = {"kind": [], "block": [], "bucket": [], "data": []}
            for a, b in zip(bounds[:-1], bounds[1:]):
                if a < b:
                    part = order[a:b]
                    more = [counts[part]] if counted is not None else []
                    out["kind"].append("words")
                    out["block"].append(block)
                    out["bucket"].append(int(bucket[part[0]]))
                    out["data"].append(pack_words([words[i] for i in part], *more))
            yield pa.RecordBatch.from_pydict({"kind": out["kind"], "block": out["block"], "bucket": pa.array(out["bucket"], pa.int32()), "data": pa.array(out["data"], pa.binary())})

    return docs.select("doc_id", "text").mapInArrow(run, TABLE)


def answered(table: DataFrame, replies: DataFrame, finish: Callable, schema: str) -> DataFrame:
    """Joins each block's documents with the replies to its words; ``finish`` turns both into result rows.

    ``replies`` has block, bucket, data, where data packs arrays in the order of the
    words that the block sent to that bucket.  ``finish`` gets the arrays by local word
    number, the documents' arrays and a function that sums over each document.
    """
    docs = table.where("kind = 'docs'").select("block", "data")
    got = replies.groupBy("block").agg(F.collect_list(F.struct("bucket", F.col("data").alias("reply"))).alias("replies"))

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                number, mask, lengths, diff, freq, bucket, *columns = unpack(batch.column(1)[k].as_py())
                lengths = lengths.astype(np.int64)
                starts = np.cumsum(lengths) - lengths
                ids = undeltas(diff, starts, lengths)
                values: list[np.ndarray] = []
                order = np.argsort(bucket, kind="stable")
                sorted_bucket = bucket[order]
                for reply in batch.column(2)[k].as_py() or ():
                    a, b = np.searchsorted(sorted_bucket, [reply["bucket"], reply["bucket"] + 1])
                    arrays = unpack(reply["reply"])
                    if not values:
                        values = [np.zeros(len(bucket), x.dtype) for x in arrays]
                    for have, new in zip(values, arrays):
                        have[order[a:b]] = new

                def total(per_word, ids=ids, freq=freq, starts=starts, lengths=lengths):
                    each = per_word[ids] * freq if len(ids) else np.zeros(0, per_word.dtype)
                    sums = np.concatenate([np.zeros(1, each.dtype), np.cumsum(each)])
                    if each.dtype.kind == "f":  # sums of differences would depend on what stands before
                        out = np.zeros(len(starts))
                        full = np.flatnonzero(lengths)
                        if len(full):
                            out[full] = np.add.reduceat(each, starts[full])
                        return out
                    return sums[starts + lengths] - sums[starts]

                ids_out = pa.array(number, mask=mask)
                for at in range(0, len(number), 10_000):
                    cut = slice(at, at + 10_000)
                    yield pa.RecordBatch.from_pydict({n: pa.array(v)[cut] if not isinstance(v, pa.Array) else v[cut] for n, v in finish(ids_out, columns, values, total).items()})

    return docs.join(got, "block", "left").select("block", "data", "replies").mapInArrow(run, schema)
