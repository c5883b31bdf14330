"""Passes over the ordered blocks and characters of documents, as windows within a document.

A block table has a document, an order, a text and, where a pass needs them, style
('normal', 'bold', 'italic'), size, page and kind.  Passes add, change or drop rows and
keep all other columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstone.functions import fixed
from turnstone.functions.taxonomy import first_match

SLACK = 0.5
DASH_END, DASH_BEGIN = r"\s*[—–-]\s*$", r"^\s*[—–−-]"


def by(doc: str | Sequence[str], order: str):
    return Window.partitionBy(*([doc] if isinstance(doc, str) else doc)).orderBy(order)


def event_kind(text: Column) -> Column:
    """The kind of a note, in lower case, by the first pattern that it holds."""
    return first_match(F.lower(text), fixed.EVENT_SUBTYPES, "unspecified")


def is_body(size: Column, body: Column | float) -> Column:
    """Within half a point of the body's size; false for an unknown size."""
    return F.coalesce(F.abs(size - body) <= SLACK, F.lit(False))


def on_page(x0: Column, x1: Column, top: Column, bottom: Column, left: Column, upper: Column, right: Column, lower: Column) -> Column:
    """Whether any of a character's box lies on its page."""
    return (x1 > left) & (x0 < right) & (bottom > upper) & (top < lower)


def scanned_pages(images: DataFrame, page: Sequence[str], width: str, height: str, area: str, share: float = 0.6, order: Sequence[str] = ()) -> DataFrame:
    """Pages and whether images cover more than that share of them; boxes turned inside out count nothing.

    Sums of floats depend on the order of adding.  With ``order`` boxes count as added in it: pages whose sum is
    so near the limit that rounding could decide are added up once more, one box after another.
    """
    box = F.greatest(F.lit(0.0), F.col(width)) * F.greatest(F.lit(0.0), F.col(height))
    rows = images.select(*page, *order, box.alias("_box"), F.col(area).alias("_area"))
    sums = rows.groupBy(*page).agg(F.coalesce(F.sum("_box"), F.lit(0.0)).alias("_sum"), (share * F.max("_area")).alias("_limit"), F.count("*").alias("_n"))
    verdict = (F.col("_sum") > F.col("_limit")).alias("scanned")
    if not order:
        return sums.select(*page, verdict)
    # No box is negative, so two orders differ by less than 2 n roundings of the sum.
    clear = F.coalesce((F.col("_sum") == 0) | (F.abs(F.col("_sum") - F.col("_limit")) > F.col("_n") * 2.0**-51 * F.col("_sum")), F.lit(True))
    near = sums.where(~clear).select(*[F.col(c).alias(f"_near_{k}") for k, c in enumerate(page)], "_limit")
    own = rows.join(near, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_near_{k}")) for k, c in enumerate(page)]))
    w = Window.partitionBy(*page).orderBy(*order)
    added = own.withColumn("_sum", F.sum("_box").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = added.groupBy(*page).agg(F.max_by("_sum", F.struct(*order)).alias("_sum"), F.first("_limit").alias("_limit"))
    return sums.where(clear).select(*page, verdict).union(last.select(*page, verdict))


def body_sizes(chars: DataFrame, doc: str, size: str, normal: Column, most: int = 3, least: float = 0.05) -> DataFrame:
    """doc, rank, size: the most frequent sizes of a document's normal characters that have their share of them; ties to the smaller size."""
    counts = chars.where(normal).groupBy(doc, size).agg(F.count("*").alias("n"))
    every = Window.partitionBy(doc)
    ranked = counts.withColumns({"rank": F.row_number().over(every.orderBy(F.col("n").desc(), F.col(size))), "total": F.sum("n").over(every)})
    return ranked.where((F.col("rank") <= most) & ((F.col("n") >= least * F.col("total")) | (F.col("rank") == 1))).select(doc, "rank", size)


def hyphens_forward(blocks: DataFrame, doc: str, order: str, text: str, style: str) -> DataFrame:
    """A hyphen that ends a block goes to the beginning of an italic block after it."""
    w = by(doc, order)
    trimmed = F.trim(F.col(text))
    gives = F.coalesce(trimmed.endswith("-") & (F.lead(style).over(w) == "italic"), F.lit(False))
    out = blocks.withColumn("_gives", gives)
    takes = F.coalesce(F.lag("_gives").over(w), F.lit(False)) & (F.col(style) == "italic")
    out = out.withColumn("_takes", takes)
    own = F.when(F.col("_takes"), F.concat(F.lit("-"), trimmed)).otherwise(F.col(text))
    return out.withColumn(text, F.when(F.col("_gives"), F.regexp_replace(F.trim(own), "-+$", "")).otherwise(own)).drop("_gives", "_takes")


def split_words_joined(blocks: DataFrame, doc: str, order: str, text: str, style: str, size: str, body: Column | float) -> DataFrame:
    """A piece off the body's size that ends inside a word goes before the body block that continues it in lower case."""
    w = by(doc, order)
    piece = F.regexp_replace(F.trim(F.col(text)), r"^\s*\.?\s*[–—−─-]\s*", "")
    body_row = is_body(F.col(size), body)
    goes = ~body_row & piece.rlike(r"\p{L}$") & F.lead(body_row).over(w) & (F.lead(style).over(w) != "bold") & F.lead(F.ltrim(F.col(text))).over(w).rlike(r"^\p{Ll}")
    out = blocks.withColumns({"_goes": F.coalesce(goes, F.lit(False)), "_piece": piece})
    before = F.when(F.lag("_goes").over(w), F.concat(F.lag("_piece").over(w), F.ltrim(F.col(text)))).otherwise(F.col(text))
    return out.withColumn(text, before).where(~F.col("_goes")).drop("_goes", "_piece")


def welded_notes_split(blocks: DataFrame, text: str, kind: str, owner: Sequence[str] = ()) -> DataFrame:
    """Notes printed on lines of their own but read as one become rows (``part``); later ones lose their ``owner`` columns."""
    mark = r"(?<=[.!?:)])\s+(?=[—–-](?:\s|[¡¿A-ZÁÉÍÓÚÑ]))"
    parts = F.filter(F.split(F.col(text), mark), lambda x: F.trim(x) != "")
    several = (F.col(kind) == "event") & (F.size(parts) > 1)
    out = blocks.select("*", F.posexplode(F.when(several, F.transform(parts, F.trim)).otherwise(F.array(text))).alias("part", "_text"))
    out = out.withColumn(text, F.col("_text")).drop("_text")
    return out.withColumns({c: F.when(F.col("part") == 0, F.col(c)) for c in owner})


def classified(blocks: DataFrame, doc: str, order: str, text: str, style: str, size: str, body: Column | float) -> DataFrame:
    """Adds kind (furniture, event, inline, null for what later passes decide) and event_type.

    Off the body's size is furniture, and so is the office's sign-off.  Italic blocks are notes if a dash
    introduces them (their own, or one left at the end of the block before a sentence), if they stand in brackets, or if they
    read like a note of a known kind; other italics are words set in italics.
    """
    t = F.trim(F.col(text))
    sign_off = t.rlike("^" + fixed.FURNITURE["stenographers' office"]) | ((F.length(t) < 80) & t.rlike(fixed.SIGN_OFF))
    sentence = t.rlike(r"^\p{Lu}") & ((F.length(t) > 15) | t.endswith("."))
    stranded = F.coalesce(F.lag(text).over(by(doc, order)).rlike(DASH_END), F.lit(False))
    known = event_kind(t)
    note = t.rlike(DASH_BEGIN) | t.startswith("(") | (sentence & stranded) | (sentence & (known != "unspecified"))
    kind = F.when(sign_off | ~is_body(F.col(size), body), "furniture").when(F.col(style) == "italic", F.when(note, "event").otherwise("inline"))
    return blocks.withColumn("kind", kind).withColumn("event_type", F.when(F.col("kind") == "event", known))


def dashes_returned(blocks: DataFrame, doc: str, order: str, text: str, kind: str) -> DataFrame:
    """A dash left at the end of an unclassified block goes back to the note after it, if that has none."""
    w = by(doc, order)
    gives = F.col(kind).isNull() & (F.lead(kind).over(w) == "event") & F.col(text).rlike(DASH_END) & ~F.lead(text).over(w).rlike(DASH_BEGIN)
    out = blocks.withColumn("_gives", F.coalesce(gives, F.lit(False)))
    out = out.withColumn("_takes", F.coalesce(F.lag("_gives").over(w), F.lit(False)))
    new = F.when(F.col("_gives"), F.regexp_replace(text, DASH_END, " ")).when(F.col("_takes"), F.concat(F.lit("— "), F.ltrim(F.col(text)))).otherwise(F.col(text))
    return out.withColumn(text, new).drop("_gives", "_takes")


def fused_labels_split(blocks: DataFrame, text: str, style: str, title: str = r"(?:Sr|Sra|Srta|Sres)\.\s") -> DataFrame:
    """A bold heading that ends in a label becomes two rows (``part``): the last title begins the label."""
    pattern = rf"^(.*\S)\s+({title}.*)$"
    own = (F.col(style) == "bold") & ~F.trim(F.col(text)).rlike(f"^{title}") & F.trim(F.col(text)).rlike(pattern)
    pair = F.array(F.regexp_extract(F.trim(F.col(text)), pattern, 1), F.regexp_extract(F.trim(F.col(text)), pattern, 2))
    return blocks.select("*", F.posexplode(F.when(own, pair).otherwise(F.array(text))).alias("part", "_text")).withColumn(text, F.col("_text")).drop("_text")


def first_speech_cleaned(blocks: DataFrame, doc: str, order: str, turn: str, text: str, kind: str) -> DataFrame:
    """The first speech of each turn loses a terminator left before its first word."""
    w = Window.partitionBy(doc, turn, kind).orderBy(order)
    residue = r"^\s*(?:[.,](?![.])\s*[─—–\-]{0,2}|[─—–\-]{1,2})\s*(?=[¿¡\"“«(A-ZÁÉÍÓÚÑ])"
    first = (F.col(kind) == "speech") & (F.row_number().over(w) == 1)
    return blocks.withColumn("_first", first).withColumn(text, F.when(F.col("_first"), F.regexp_replace(text, residue, "")).otherwise(F.col(text))).drop("_first")


def without_empty(blocks: DataFrame, text: str) -> DataFrame:
    """Without blocks that hold nothing but space and unmapped glyphs."""
    return blocks.where(F.trim(F.regexp_replace(text, r"\(cid:\d+\)", "")) != "")


def chapters(blocks: DataFrame, doc: str, order: str, text: str, title: Column, most_ahead: int = 3, first: int = 10) -> DataFrame:
    """Adds chapter: the number of the last numbered title, carried forward.

    A title whose number is followed by a stop always counts; another one only if it
    continues the count by up to ``most_ahead``, or opens it at up to ``first``.
    """
    w = by(doc, order)
    number = F.regexp_extract(F.trim(F.col(text)), r"^(\d{1,6})", 1).try_cast("int")
    named = F.when(title, number)
    step = F.struct(named.alias("n"), F.coalesce(F.trim(F.col(text)).rlike(r"^\d+\."), F.lit(False)).alias("sure"))
    steps = F.collect_list(F.when(named.isNotNull(), step)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    goes = lambda have, s: s["sure"] | F.when(have.isNull(), s["n"] <= first).otherwise((s["n"] - have > 0) & (s["n"] - have <= most_ahead))
    return blocks.withColumn("chapter", F.aggregate(steps, F.lit(None).cast("int"), lambda have, s: F.when(goes(have, s), s["n"]).otherwise(have)))


def turn_shape_faults(blocks: DataFrame, doc: str, order: str, text: str, kind: str, speaker: str) -> DataFrame:
    """Speech that does not begin or end as speech does: doc, order, fault.

    ``scrap``: three characters or fewer but for short answers; ``dangling``: ends on a dash or comma; ``mid_word``:
    opens in lower case, not after a note, under another speaker than the speech before.
    """
    w = by(doc, order)
    t = F.trim(F.regexp_replace(F.col(text), r"\s+", " "))
    last = F.last(F.when(F.col(kind) == "speech", F.col(speaker)), True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    faults = F.array(
        F.when((F.length(t) <= 3) & ~t.rlike(r"^(Sí|No|Ya)\.?$"), "scrap"),
        F.when(t.rlike(r"[—–\-,;]$"), "dangling"),
        F.when(t.rlike("^[a-záéíóúñ]") & (F.lag(kind).over(w) != "event") & (last != F.col(speaker)), "mid_word"),
    )
    found = blocks.withColumn("_faults", F.filter(faults, lambda x: x.isNotNull()))
    return found.where((F.col(kind) == "speech") & (t != "")).select(doc, order, F.explode("_faults").alias("fault"))


def opening_dates(blocks: DataFrame, doc: str, order: str, text: str, own: str, head: int = 40) -> DataFrame:
    """Documents whose opening names another date than their own: doc, own, said, days_off."""
    from turnstone.functions.text import deaccent

    numbered = blocks.withColumn("_n", F.row_number().over(by(doc, order))).where(F.col("_n") <= head)
    rows = F.sort_array(F.collect_list(F.struct("_n", F.coalesce(text, F.lit("")).alias("t"))))
    opening = numbered.groupBy(doc).agg(F.min(own).alias(own), deaccent(F.lower(F.array_join(F.transform(rows, lambda r: r["t"]), " "))).alias("_head"))
    months = F.array_position(F.array(*map(F.lit, fixed.MONTHS)), F.replace(F.regexp_extract("_head", fixed.OPENING_DATE, 2), F.lit("setiembre"), F.lit("septiembre")))
    day, year = (F.regexp_extract("_head", fixed.OPENING_DATE, k) for k in (1, 3))
    said = F.when(months > 0, F.concat_ws("-", year, F.lpad(months.cast("string"), 2, "0"), F.lpad(day, 2, "0")).try_cast("date"))
    return opening.withColumn("said", said).where(F.col("said") != F.col(own)).select(doc, own, "said", F.date_diff("said", own).alias("days_off"))


def inserted_debate_unattributed(blocks: DataFrame, doc: str, order: str, turn: str, kind: str, first: Column, last: Column) -> DataFrame:
    """Rows from a reprint's first to its last words are nobody's; turns close up."""
    from turnstone.operators.segmentation import dense_turns

    w = Window.partitionBy(doc)
    begin = F.min(F.when(F.coalesce(first, F.lit(False)), F.col(order))).over(w)
    out = blocks.withColumn("_begin", begin)
    out = out.withColumn("_end", F.min(F.when(F.coalesce(last, F.lit(False)) & (F.col(order) >= F.col("_begin")), F.col(order))).over(w))
    inside = F.coalesce(F.col(order).between(F.col("_begin"), F.col("_end")) & F.col(kind).isin("speech", "event"), F.lit(False))
    out = out.withColumn("_in", inside).withColumns({kind: F.when(F.col("_in"), "other").otherwise(F.col(kind)), turn: F.when(~F.col("_in"), F.col(turn))})
    return dense_turns(out.drop("_begin", "_end", "_in"), doc, turn)
