"""Where passages stand in their source, which occurrence they are, and what pages repeat."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstone.functions.text import as_read, header_signature, letters_and_digits
from turnstone.operators.containment import probe_windows, rebuilt_from

KEY = 150


def starts(source: str, quote: str) -> list[int]:
    """Where the quote begins in the source, but not inside a word."""
    out, at = [], source.find(quote) if quote else -1
    while at >= 0:
        if not at or not source[at - 1].isalnum():
            out.append(at)
        at = source.find(quote, at + 1)
    return out


def places(source: str, passages: list[str], key: int = KEY) -> list[int | None]:
    """Where each passage stands, each looked for after the one before and, failing that, from the beginning."""
    out, after = [], 0
    for p in passages:
        at = -1
        if p:
            at = source.find(p[:key], after)
            at = at if at >= 0 else source.find(p[:key])
        if at >= 0:
            after = max(after, at + len(p))
        out.append(at if at >= 0 else None)
    return out


def placed(passages: DataFrame, sources: DataFrame, doc: str, order: str, text: str, source: str, quote: int = 60) -> DataFrame:
    """doc, order, place, occurrence, occurrences of each passage.

    The place is in the source as it is read (folded, without space).  The occurrence counts the passage's opening words down
    the source to its place; it is null where the passage has none.
    """
    rows = passages.select(doc, F.struct(F.col(order).alias("o"), as_read(F.col(text)).alias("t")).alias("r"))
    grouped = rows.groupBy(doc).agg(F.sort_array(F.collect_list("r")).alias("rows"))
    joined = sources.select(doc, as_read(F.col(source)).alias("source")).join(grouped, doc).select(doc, "source", "rows")
    kinds = dict(joined.dtypes) | {"order": dict(passages.dtypes)[order]}

    def run(batches):
        for batch in batches:
            for key, src, own in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                src, texts = src or "", [r["t"] or "" for r in own]
                found = places(src, texts)
                heads = [starts(src, t[:quote]) for t in texts]
                nth = [None if at is None else sum(h < at for h in hits) + 1 for at, hits in zip(found, heads)]
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * len(own), batch.column(0).type), pa.array([r["o"] for r in own], pa.int64()), pa.array(found, pa.int64()), pa.array(nth, pa.int64()), pa.array([len(h) for h in heads], pa.int64())], [doc, order, "place", "occurrence", "occurrences"])

    return joined.mapInArrow(run, f"`{doc}` {kinds[doc]}, `{order}` long, place long, occurrence long, occurrences long")


def audited(passages: DataFrame, sources: DataFrame, doc: str, text: str, source: str) -> DataFrame:
    """By document: source_chars, output_chars, probed, located, foreign_share, duplication.

    A passage is located if one of its probes is in the source or if it can be rebuilt from it in a few runs.
    """

    @F.pandas_udf(T.BooleanType())
    def rebuilt(a, b):
        return a.combine(b, rebuilt_from)

    src = sources.select(doc, letters_and_digits(F.col(source)).alias("_source"))
    own = passages.select(doc, letters_and_digits(F.coalesce(text, F.lit(""))).alias("_text")).withColumn("_probes", probe_windows(F.col("_text")))
    pairs = own.join(src, doc).withColumn("_probed", F.size("_probes") > 0)
    pairs = pairs.withColumn("_hit", F.exists("_probes", lambda p: F.col("_source").contains(p)))
    pairs = pairs.withColumn("_located", F.when(~F.col("_probed"), False).when(F.col("_hit"), True).otherwise(rebuilt(F.when(F.col("_probed") & ~F.col("_hit"), F.col("_text")).otherwise(F.lit("")), F.when(F.col("_probed") & ~F.col("_hit"), F.col("_source")).otherwise(F.lit("")))))
    sums = pairs.groupBy(doc).agg(F.max(F.length("_source")).alias("source_chars"), F.sum(F.length("_text")).alias("output_chars"), F.count_if("_probed").alias("probed"), F.count_if("_located").alias("located"))
    return sums.withColumns({"foreign_share": (F.col("probed") - F.col("located")) / F.greatest("probed", F.lit(1)), "duplication": F.col("output_chars") / F.greatest("source_chars", F.lit(1))})


def running_header(signatures: list[str], least: int = 12, least_pages: int = 3, share: float = 0.3, stays: float = 0.8) -> str | None:
    """The beginning that most pages' top strips share.

    Grown from ``least`` characters on while each longer one keeps ``stays`` of the pages of the one before; the first
    must be on ``least_pages`` and on that ``share`` of all pages that have a strip.
    """
    own = sorted(s for s in signatures if len(s) >= least)
    pages, best, held = max(1, sum(map(bool, signatures))), None, 0
    for n in range(least, max(map(len, own), default=0) + 1):
        counts: dict[str, int] = {}
        for s in own:
            if len(s) >= n:
                counts[s[:n]] = counts.get(s[:n], 0) + 1
        head = max(counts, key=lambda k: (counts[k], -own.index(next(s for s in own if s.startswith(k)))))
        if best is None and not (counts[head] >= least_pages and counts[head] >= share * pages) or best is not None and counts[head] < stays * held:
            break
        best, held = head, counts[head]
    return best


def running_headers(pages: DataFrame, doc: str, strip: str) -> DataFrame:
    """doc, header, n_pages (with the header) of documents whose pages (``strip``: the text at their top) share one."""
    kind = dict(pages.dtypes)[doc]

    def run(table: pa.Table) -> pa.Table:
        signs = [s or "" for s in table["_sign"].to_pylist()]
        head = running_header(signs)
        keep = [head] if head else []
        return pa.table({doc: table[doc].slice(0, len(keep)), "header": pa.array(keep, pa.string()), "n_pages": pa.array([sum(s.startswith(head) for s in signs) for _ in keep], pa.int64())})

    own = pages.select(doc, F.regexp_replace(header_signature(F.col(strip)), r"\d+", "").alias("_sign"))
    return own.groupBy(doc).applyInArrow(run, f"`{doc}` {kind}, header string, n_pages long")


def symbols_decoded(c: Column) -> Column:
    """Glyphs of a symbol font in the private area, as the characters typed."""
    private = "".join(chr(0xF000 + k) for k in range(32, 127))
    return F.translate(c, private, "".join(map(chr, range(32, 127))))


def first_of_each(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row in order of each combination of keys."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
