"""Texts within texts."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstone.functions.text import letters_and_digits


def probe_windows(c: Column, width: int = 40, margin: int = 12) -> Column:
    """Up to three windows of a folded text: near its beginning, in its middle, at its end; none of short texts."""
    n = F.length(c)
    at = F.array_distinct(F.array(F.lit(10), F.greatest(F.lit(10), F.floor((n - width) / 2).cast("int")), F.greatest(F.lit(10), n - width - 1)))
    inside = F.filter(F.transform(at, lambda k: F.greatest(F.least(k, n - width), F.lit(0))), lambda k: k >= 0)
    return F.when(n >= width + margin, F.transform(F.array_distinct(inside), lambda k: F.substring(c, k + 1, F.lit(width)))).otherwise(F.array().cast("array<string>"))


def contained(items: DataFrame, texts: DataFrame, item: str, text_of: str, doc: str, text: str, width: int = 40) -> DataFrame:
    """(item, document) pairs where a document holds a probe window of the item.

    The documents' folded texts are cut into windows at every ``width // 2``-th place, the
    probes into all their substrings of that length: a probe in a text covers one of the
    text's pieces, so an equi-join finds all candidates and the containment test decides.
    """
    piece = width // 2
    probes = items.select(item, F.explode(probe_windows(letters_and_digits(F.col(text_of)), width)).alias("_probe"))
    cuts = probes.select(item, "_probe", F.explode(F.transform(F.sequence(F.lit(1), F.lit(width - piece + 1)), lambda k: F.substring("_probe", k, F.lit(piece)))).alias("_piece"))
    folded = texts.select(doc, letters_and_digits(F.col(text)).alias("_text"))
    n = F.length("_text")
    pieces = folded.where(n >= width).select(doc, F.explode(F.array_distinct(F.transform(F.sequence(F.lit(0), F.floor(n / piece).cast("int") - 1), lambda k: F.substring("_text", k * piece + 1, F.lit(piece))))).alias("_piece"))
    near = pieces.join(cuts, "_piece").select(item, doc, "_probe").distinct()
    hit = near.join(folded, doc).where(F.col("_text").contains(F.col("_probe")))
    return hit.select(item, doc).distinct()


def leak_counts(df: DataFrame, text: str, patterns: Sequence[tuple[str, str]]) -> DataFrame:
    """How many rows match each pattern."""
    counts = df.agg(*[F.count_if(F.coalesce(F.col(text).rlike(p), F.lit(False))).alias(n) for n, p in patterns])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("pattern"), F.col(n).alias("n_rows")) for n, _ in patterns])).alias("_r")).select("_r.*")


def repeated_lines(df: DataFrame, doc: str, text: str, least_length: int = 12, least_docs: int = 3) -> DataFrame:
    """Lines that many documents hold, folded to what does not change from page to page."""
    from turnstone.functions.text import header_signature

    lines = df.select(doc, F.explode(F.array_distinct(F.transform(F.split(text, "\n"), header_signature))).alias("signature"))
    return lines.where(F.length("signature") >= least_length).groupBy("signature").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= least_docs)


def rebuilt_from(text: str, source: str, most: int = 8, least: int = 1) -> bool:
    """Whether a text is a chain of at most ``most`` runs of the source, each after the one before.

    Each run is the longest that the rest of the source holds, found by doubling and halving.
    """
    at, begin = 0, 0
    for _ in range(most):
        if at >= len(text):
            return True
        lo, hi = 0, 1
        while at + hi <= len(text) and source.find(text[at : at + hi], begin) >= 0:
            lo, hi = hi, hi * 2
        hi = min(hi, len(text) - at + 1)
        while hi - lo > 1:
            mid = (lo + hi) // 2
            if source.find(text[at : at + mid], begin) >= 0:
                lo = mid
            else:
                hi = mid
        if lo < least:
            return False
        begin = source.find(text[at : at + lo], begin) + lo
        at += lo
    return at >= len(text)


def reconstructed(pairs: DataFrame, text: str, source: str, most: int = 8) -> DataFrame:
    """``pairs`` with whether each text can be rebuilt from its source."""

    @F.pandas_udf(T.BooleanType())
    def test(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([x is not None and y is not None and rebuilt_from(x, y, most) for x, y in zip(a, b)])

    return pairs.withColumn("rebuilt", test(letters_and_digits(F.col(text)), letters_and_digits(F.col(source))))
