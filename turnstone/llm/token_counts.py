"""Token counts: pieces are counted once for each distinct pre-token.

No piece of the vocabulary holds a space mark after another character, and none
holds a line feed, so no merge crosses such a place: the text between them is a
pre-token and counts add up.  Both properties are checked on the model at hand.

Each block of documents sends its distinct pre-tokens to buckets; a bucket
encodes every distinct one once, for the whole corpus, and sends the counts back;
a document's total is the sum of frequency times count.  Ids of a text are never
built.

Cases: null text counts as empty; an empty text has no tokens; repeated rows and
repeated ids give one result row each; a null id stays null; other columns of the
input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from turnstone.llm._shared import Scratch, answered, bucket_count, dictionary_table, pack, unpack_words

SPACE_MARK = "▁"
#: Runs of spaces with what follows, or a line feed with what follows.
PRE_TOKEN = re.compile(" *[^ \n]+| +|\n[^ \n]*")
_models: dict = {}


def _model(path: str):
    if path not in _models:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        if any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}|\n", p) for p in pieces):
            raise ValueError("this vocabulary merges across spaces or line feeds; pre-tokens would not add up")
        if len(model.encode("\n")) != 2 or len(model.encode("a ")) != 2:
            raise ValueError("this model does not keep spaces and line feeds as they are")
        _models[path] = model
    return _models[path]


def pre_tokens(text: str | None) -> list[str]:
    """Pre-tokens of a text.  A key without a leading space or line feed has one space before it."""
    if not text:
        return []
    if SPACE_MARK in text:
        text = text.replace(SPACE_MARK, " ")
    if "  " not in text and " \n" not in text and text[-1] != " " and text[0] != " " and text[0] != "\n":
        return text.replace("\n", " \n").split(" ")
    return [k[1:] if len(k) > 1 and k[0] == " " and k[1] not in " \n" else k for k in PRE_TOKEN.findall(" " + text)]


def pieces_of(model, keys: list[str]) -> np.ndarray:
    """How many pieces each pre-token has.  The model puts a space before what it is given."""
    plain, less = [], np.zeros(len(keys), np.int64)
    for i, key in enumerate(keys):
        if key[0] == "\n":
            plain.append(key)
            less[i] = 1
        elif key[0] == " ":
            only = not key.strip(" ")
            plain.append("a" + key if only else key[1:])
            less[i] = only
        else:
            plain.append(key)
    return np.fromiter(map(len, model.encode(plain, num_threads=1)), np.int64, len(keys)) - less


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every row of ``docs`` (doc_id, text)."""
    scratch, n = Scratch(docs.sparkSession, "token-counts"), bucket_count(docs)

    def tokenize(text):
        return pre_tokens(text), (len((text or "").encode("utf-8", "surrogatepass")),)

    table = scratch.save(dictionary_table(docs, tokenize, n), "table")

    def count(words: pa.Table) -> pa.Table:
        model, ids, sent = _model(model_path), {}, []
        for row in words["data"].to_pylist():
            keys, _ = unpack_words(row)
            sent.append(np.fromiter((ids.setdefault(k, len(ids)) for k in keys), np.int64, len(keys)))
        pieces = pieces_of(model, [k.decode("utf-8", "surrogatepass") for k in ids])
        out = [pack(pieces[x].astype(np.uint32)) for x in sent]
        return pa.table({"block": words["block"], "bucket": words["bucket"], "data": pa.array(out, pa.binary())})

    replies = table.where("kind = 'words'").select("block", "bucket", "data").groupBy("bucket").applyInArrow(count, "block long, bucket int, data binary")

    def finish(ids, columns, values, total):
        tokens = total(values[0].astype(np.int64)) if values else np.zeros(len(ids), np.int64)
        return {"doc_id": ids, "n_bytes": columns[0], "n_tokens": tokens, "over_limit": tokens > limit}

    return answered(table, replies, finish, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
