"""SimHash near-duplicates, searched with BK-trees.

Fingerprints: XXH64 of every word shingle, each bit decided by majority.  Equal
fingerprints are one class, whatever their number.

Search: two fingerprints within the radius r agree on one of r + 1 parts of their
bits, so classes that share a part's value form a shard.  A shard's tree keys a
node's children by their Hamming distance to it; a query at distance d from a node
follows only the edges d - r to d + r.  A shard beyond ``tree_limit`` classes is dealt
again by parts of the bits that are left, so trees are searched at every size and,
for radii up to 2, no tree exceeds 2^13 nodes (or ``tree_limit``).  Trees of the whole corpus have no bound, so they are not
broadcast: each is built in the task that holds its shard, which is all its queries.

Links only join sets that are still apart within their shard, so a dense group of n
gives at most n - 1 of them; components keep all that is reachable.

Cases: null, empty and blank texts have fingerprint zero and form one class, linked
like any other; texts shorter than a shingle are hashed whole; repeated rows and ids
give one result row each; a null id stays null; other columns are ignored; an empty
table gives an empty result; a long text's bits are counted in parts.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm._shared import Scratch, texts
from turnstone.llm.components import components

BITS = 64


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes."""
    counts = np.zeros(BITS, np.int64)
    big = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(big), 1 << 16):
        counts += np.unpackbits(big[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z, and the six ASCII blanks
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), np.uint64))


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed number) of every row of ``docs`` (doc_id, text)."""

    def run(batches):
        for batch in batches:
            got = [(i, fingerprint(t, shingle, seed)) for i, t in texts([batch])]
            if got:
                ids, fps = zip(*got)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


class BKTree:
    """Children keyed by their Hamming distance to the parent."""

    def __init__(self):
        self.items: list[int] = []
        self.children: list[dict[int, int]] = []

    def within(self, item: int, radius: int) -> list[int]:
        """Numbers of the items within the radius."""
        found, stack = [], [0] if self.items else []
        while stack:
            node = stack.pop()
            d = (self.items[node] ^ item).bit_count()
            if d <= radius:
                found.append(node)
            stack += [c for e, c in self.children[node].items() if d - radius <= e <= d + radius]
        return found

    def add(self, item: int) -> int:
        """Its number; an item that is there already keeps its own."""
        if self.items:
            node = 0
            while True:
                d = (self.items[node] ^ item).bit_count()
                if not d:
                    return node
                if d not in self.children[node]:
                    self.children[node][d] = len(self.items)
                    break
                node = self.children[node][d]
        self.items.append(item)
        self.children.append({})
        return len(self.items) - 1


def shard_links(items: list[int], radius: int) -> list[tuple[int, int]]:
    """Links within one shard that join sets still apart."""
    tree, parent, links = BKTree(), [], []

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for item in items:
        near = tree.within(item, radius)
        k = tree.add(item)
        if k == len(parent):
            parent.append(k)
        for other in near:
            a, b = root(k), root(other)
            if a != b:
                parent[a] = b
                links.append((item, tree.items[other]))
    return links


#: Most ways (masks of agreed bits) in which large shards are dealt again.
WAYS = 100


def parts_of(bits: list[int], n: int) -> list[list[int]]:
    """``bits`` in n parts as equal as may be."""
    edges = [len(bits) * k // n for k in range(n + 1)]
    return [bits[x:y] for x, y in zip(edges, edges[1:])]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def split_masks(masks: dict[int, int], radius: int) -> dict[int, list[int]]:
    """For each agreed mask the finer ones: it and one of radius + 1 parts of the bits that are left."""
    return {k: [m | sum(1 << b for b in part) for part in parts_of([b for b in range(BITS) if not m >> b & 1], radius + 1)] for k, m in masks.items()}


def shard_key(mask: int, path: int) -> F.Column:
    return F.xxhash64(F.lit(path), F.col("fp").bitwiseAND(F.lit(signed(mask))))


def sharded(classes: DataFrame, scratch: Scratch, radius: int, tree_limit: int) -> list[DataFrame]:
    """Tables (key, fp) of shards in which every pair within the radius meets.

    Two fingerprints within the radius agree on one of radius + 1 parts of any bits.  A
    shard of more than ``tree_limit`` classes is dealt again by parts of the bits that its
    classes do not agree on, and so on while there are no more than ``WAYS`` ways of dealing.
    For radii up to 2 the last of them leave 13 bits open, so no shard has more than
    2^13 classes.  Keys are hashes: two shards that share one are searched as one.
    """
    rows, masks, out, depth = classes.select("fp", F.lit(-1).alias("path")), {-1: 0}, [], 0
    while True:
        finer, named, keys = split_masks(masks, radius), [], None
        for path, found in sorted(finer.items()):
            own = F.array(*[F.struct(shard_key(m, (depth << 32) + len(named) + k).alias("key"), F.lit(len(named) + k).alias("path")) for k, m in enumerate(found)])
            keys = F.when(F.col("path") == path, own) if keys is None else keys.when(F.col("path") == path, own)
            named += found
        level = rows.select("fp", F.explode(keys).alias("k")).select("k.key", "k.path", "fp")
        sizes = scratch.save(level.groupBy("key", "path").agg(F.count("*").alias("n")).where("n > 1"), f"sizes-{depth}")
        last = len(named) * (radius + 1) > WAYS
        several = sizes if last else sizes.where(F.col("n") <= tree_limit)
        out.append(level.join(several.select("key"), "key", "left_semi").select("key", "fp"))
        large = sizes.where(F.col("n") > tree_limit)
        grown = [] if last else [r["path"] for r in large.select("path").distinct().collect()]
        if not grown:
            return out
        rows = scratch.save(level.join(large.select("key"), "key", "left_semi").select("fp", "path").distinct(), f"dense-{depth}")
        masks, depth = {p: named[p] for p in grown}, depth + 1


def linked(classes: DataFrame, scratch: Scratch, radius: int = 2, tree_limit: int = 2048) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that reach all within the radius of each other."""

    def search(batches):
        key, held = None, []
        for batch in batches:
            ks, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(ks)) + 1, [len(ks)]])
            found = []
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if lo == hi:
                    continue
                if ks[lo] != key:
                    found += shard_links(held, radius)
                    key, held = ks[lo], []
                held += fps[lo:hi].tolist()
            if found:
                yield links_batch(found)
        if found := shard_links(held, radius):
            yield links_batch(found)

    def links_batch(found):
        return pa.RecordBatch.from_arrays([pa.array([signed(x) for x in side], pa.int64()) for side in zip(*found)], ["a", "b"])

    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = sharded(classes, scratch, radius, tree_limit)
    tables = [t.repartition(parts, "key").sortWithinPartitions("key", "fp").mapInArrow(search, "a long, b long") for t in shards]
    links = tables[0]
    for t in tables[1:]:
        links = links.union(t)
    return scratch.save(links, "found")


def near_duplicates(docs: DataFrame, shingle: int = 3, seed: int = 42, radius: int = 2, tree_limit: int = 2048) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest doc_id reachable) of every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "simhash")
    own = scratch.save(fingerprints(docs, shingle, seed), "fingerprints")
    classes = scratch.save(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    found = components(linked(classes, scratch, radius, tree_limit), scratch)
    rooted = scratch.save(classes.join(found, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = scratch.save(rooted.join(least, "root").select("fp", "component_id"), "named")
    return own.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
