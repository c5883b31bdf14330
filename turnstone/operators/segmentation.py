"""Ordered passes over the pieces of documents, as windows within a document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def turns(df: DataFrame, doc: str, order: Sequence[str], opens: Column, closes: Column | None = None, label: Column | None = None) -> DataFrame:
    """Numbers turns: a row that opens begins the next one; what follows stays in it until a row closes it.

    Adds turn_id (null outside turns) and, with ``label``, the turn's label carried forward.
    """
    w = Window.partitionBy(doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn("_open", F.coalesce(opens, F.lit(False)))
    out = out.withColumn("_shut", F.coalesce(closes, F.lit(False)) if closes is not None else F.lit(False))
    out = out.withColumn("_n", F.sum(F.col("_open").cast("long")).over(w))
    out = out.withColumn("_state", F.last(F.when(F.col("_open"), True).when(F.col("_shut"), False), True).over(w))
    out = out.withColumn("turn_id", F.when(F.coalesce("_state", F.lit(False)), F.col("_n")))
    if label is not None:
        out = out.withColumn("turn_label", F.when(F.col("turn_id").isNotNull(), F.last(F.when(F.col("_open"), label), True).over(w)))
    return out.drop("_open", "_shut", "_n", "_state")


def consolidated(df: DataFrame, doc: str, order: str, same: Sequence[str], text: str, glue: str = " ") -> DataFrame:
    """Adjacent rows that agree on ``same`` become one, their texts joined in order."""
    w = Window.partitionBy(doc).orderBy(order)
    changed = F.lit(False)
    for c in same:
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    first = F.lag(F.lit(1)).over(w).isNull()
    out = df.withColumn("_new", (first | changed).cast("int")).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = F.sort_array(F.collect_list(F.struct(order, text)))
    return out.groupBy(doc, "_run", *same).agg(F.min(order).alias(order), F.count("*").alias("n_rows"), F.array_join(F.transform(rows, lambda r: r[text]), glue).alias(text)).drop("_run")


def run_grouped(chars: DataFrame, doc: str, order: str, style: Sequence[str], text: str) -> DataFrame:
    """Characters of equal style and neighbouring places become blocks."""
    return consolidated(chars, doc, order, style, text, "")


def missing_space(doc: str, order: str, gap: Column, size: Column, line: str, page: str, text: str) -> Column:
    """Whether a space belongs before a character: a wide gap, a new line (but after a hyphen) or a new page."""
    w = Window.partitionBy(doc).orderBy(order)
    hyphen = F.lag(text).over(w).isin("-", "‐")
    new_line = (F.col(line) != F.lag(line).over(w)) & ~hyphen
    new_page = F.col(page) != F.lag(page).over(w)
    return F.coalesce((gap > 0.15 * size) | new_line | new_page, F.lit(False))


def split_at(df: DataFrame, text: str, pattern: str, keep_first: Sequence[str] = ()) -> DataFrame:
    """One row for each part of a text; columns of ``keep_first`` are null on all but the first part."""
    parts = df.select(*[c for c in df.columns if c != text], F.posexplode(F.split(text, pattern)).alias("part", text))
    for c in keep_first:
        parts = parts.withColumn(c, F.when(F.col("part") == 0, F.col(c)))
    return parts


def cut_before(df: DataFrame, doc: str, order: str, rules: Sequence[Column]) -> DataFrame:
    """Drops what stands before the opening: the first row of the first rule that a document has at all."""
    w = Window.partitionBy(doc)
    firsts = [F.min(F.when(F.coalesce(r, F.lit(False)), F.col(order))).over(w) for r in rules]
    return df.withColumn("_from", F.coalesce(*firsts)).where(F.col("_from").isNull() | (F.col(order) >= F.col("_from"))).drop("_from")


def demote_after(df: DataFrame, doc: str, order: str, last: Column, kind: str, demoted: Column, to: str) -> DataFrame:
    """Rows after the last closing row that meet ``demoted`` change their kind."""
    w = Window.partitionBy(doc)
    end = F.max(F.when(F.coalesce(last, F.lit(False)), F.col(order))).over(w)
    return df.withColumn("_end", end).withColumn(kind, F.when((F.col(order) > F.col("_end")) & F.coalesce(demoted, F.lit(False)), to).otherwise(F.col(kind))).drop("_end")


def page_edges(chars: DataFrame, page: Sequence[str], top: str, anchor: Column, below: bool) -> DataFrame:
    """Drops characters at or above a page's last anchor (headers), or at or below its first (footers)."""
    agg = F.min(F.when(anchor, F.col(top))) if below else F.max(F.when(anchor, F.col(top)))
    edge = agg.over(Window.partitionBy(*page))
    keep = F.col(top) < F.col("_edge") if below else F.col(top) > F.col("_edge")
    return chars.withColumn("_edge", edge).where(F.col("_edge").isNull() | keep).drop("_edge")


def dense_turns(df: DataFrame, doc: str, turn: str) -> DataFrame:
    """Turn numbers without gaps, nulls kept."""
    w = Window.partitionBy(doc, F.col(turn).isNull()).orderBy(turn)
    return df.withColumn(turn, F.when(F.col(turn).isNotNull(), F.dense_rank().over(w)))


def shape_faults(df: DataFrame, label: str) -> DataFrame:
    """Distinct labels and which shape tests they fail."""
    c = F.col(label)
    tests = {"too_long": F.length(c) > 60, "ends_open": c.rlike("[\\-–—:(]\\s*$"), "unbalanced": F.length(F.regexp_replace(c, "[^(]", "")) != F.length(F.regexp_replace(c, "[^)]", ""))}
    return df.where(c.isNotNull()).select(label).distinct().withColumns(tests).where(" OR ".join(tests))
