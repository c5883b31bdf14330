"""Packing by power-of-two decomposition.

A document's ids, with the end id, are cut into whole sequences of the largest
length and then into the powers of two of what is left, longest first.  Every
piece is a sequence of its own: none crosses documents and none needs padding.
Pieces of equal length form a bucket.  Sequences are numbered bucket by bucket and
lie in that order within what a task writes, so a training batch takes a range of
numbers; ``save_buckets`` writes a folder for each bucket.

Ids come from the tokenizer file at hand.  Words between single spaces are
pre-token boundaries of its pattern, so each distinct word is encoded once per
worker and looked up after that; texts with other white space, special strings or
rare characters go through the tokenizer as a whole.

``sequence_id`` is unique: the bucket, then the number of the piece's partition and its
place in it, the same again if a task is repeated.

Cases: null text counts as empty and gives the end id alone; repeated rows and
repeated ids are packed each on its own; a null id stays null; other columns are
ignored; an empty table gives an empty result; a long text gives as many whole
sequences as it fills.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm._shared import texts

#: Characters on whose classes Unicode versions agree; others go to the tokenizer itself.
COMMON = re.compile("[\n\x21-\x7e\xa1-\xac\xae-ÿ‐-‧]+(?: [\n\x21-\x7e\xa1-\xac\xae-ÿ‐-‧]+)*")
#: Words that a worker remembers before it starts anew.
REMEMBERED = 400_000
_encoders: dict = {}


class Encoder:
    """Ids of whole texts as little-endian 32-bit values."""

    def __init__(self, path: str, ranks_path: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes | None] = {}

    def slow(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: str) -> bytes | None:
        """Ids of a word and the space before it; None if its ends would join other white space."""
        if not word or word[0].isspace() or word[-1].isspace() or not COMMON.fullmatch(word):
            out = None
        else:
            out = np.array(self.fast.encode_ordinary(" " + word), "<u4").tobytes()
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[word] = out
        return out

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.fast is None or any(s in text for s in self.special):
            return self.slow(text)
        first, *rest = text.split(" ")
        known, word, out = self.known, self.word, []
        for w in rest:
            ids = known.get(w) or word(w)
            if ids is None:
                return self.ordinary(text)
            out.append(ids)
        if not first or first[-1].isspace() or not COMMON.fullmatch(first):
            return self.ordinary(text)
        return np.array(self.fast.encode_ordinary(first), "<u4").tobytes() + b"".join(out)

    def ordinary(self, text: str) -> bytes:
        """A text whose white space or characters rule out the way by words."""
        if COMMON.fullmatch(re.sub(r"[ \t\r]+", " ", text).strip(" ")):
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        return self.slow(text)


def encoder(path: str, ranks_path: str | None = None, pattern: str | None = None) -> Encoder:
    key = (path, ranks_path, pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def piece_lengths(n: int, longest: int) -> list[int]:
    """Whole sequences, then the powers of two of the rest, longest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]


def pack_documents(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None, longest: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of all documents with their ids.

    doc_id, start, length, ids (little-endian 32-bit, binary), doc_tokens, bucket
    (log2 of the length), sequence_id, offset.  ``ranks_path`` and ``pattern`` name the
    same vocabulary in the faster library's form.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")

    def run(batches):
        enc, end = encoder(tokenizer_path, ranks_path, pattern), np.array([end_id], "<u4").tobytes()
        out: list[tuple] = []
        held = 0
        for doc_id, text in texts(batches):
            ids = enc.encode(text) + end
            n, start = len(ids) // 4, 0
            for length in piece_lengths(n, longest):
                out.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], n))
                start += length
                held += 4 * length
            if held > 4 << 20 or len(out) > 20_000:
                yield batch(out)
                out, held = [], 0
        if out:
            yield batch(out)

    def batch(rows):
        d, s, n, i, t = zip(*sorted(rows, key=lambda r: -r[2]))
        return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(s, pa.int64()), pa.array(n, pa.int64()), pa.array(i, pa.binary()), pa.array(t, pa.int64())], ["doc_id", "start", "length", "ids", "doc_tokens"])

    pieces = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long")
    # A partition has 33 bits for its own numbers and 24 for its own place, which leaves six for the bucket.
    bucket = F.round(F.log2("length")).cast("int")
    number = F.monotonically_increasing_id()
    return pieces.withColumn("bucket", bucket).withColumns({"sequence_id": F.shiftleft(F.col("bucket").cast("long"), 57).bitwiseOR(number), "offset": F.lit(0).cast("long")})


def save_buckets(pieces: DataFrame, path: str) -> None:
    """Writes pieces with a folder for each bucket, ``bucket=<log2 of the length>``."""
    pieces.write.partitionBy("bucket").parquet(path)


def batch_of(pieces: DataFrame, bucket: int, n: int, after: int = -1) -> DataFrame:
    """The ``n`` sequences of one bucket that follow the number ``after``."""
    return pieces.where((F.col("bucket") == bucket) & (F.col("sequence_id") > after)).orderBy("sequence_id").limit(n)
