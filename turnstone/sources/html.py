"""HTML documents as styled paragraphs."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstone.functions.fixed import LATIN1

# Tags that end a paragraph, those that set a style, and those whose content is not text.
BREAKS = "p br hr li tr div h1 center table ul multicol blockquote dir".split()
HEADINGS = "h1 h2 h3 h4".split()
STYLES = {"bold": ("b", "strong", r"(?i)font-weight\s*:\s*(bold|[6-9]00)"), "italic": ("i", "em", "cite", r"(?i)font-style\s*:\s*italic")}
SILENT = "sup script style title".split()
SMALL_SIZES = ("-1", "-2", "1", "2")
CENTRED = r"(?i)text-align\s*:\s*center"
INVERTED = r"(?i)(<font\b(?=[^>]*\bface\s*=\s*[\"'](?:WP TypographicSymbols|Courier New)[\"'])[^>]*>\s*)([()])(?=\s*</font\s*>)"
HEAD_CHARS = 4_000
SMALL_SHARE = 0.6

RUN = T.StructType([T.StructField("text", T.StringType()), T.StructField("bold", T.BooleanType()), T.StructField("italic", T.BooleanType())])
FLAGS = ("center", "multicol", "listitem", "after_rule", "link_only", "small")
PARAGRAPH = T.StructType([T.StructField("runs", T.ArrayType(RUN)), *[T.StructField(f, T.BooleanType()) for f in FLAGS]])


@dataclass
class Open:
    """An element that is still open: what it lends to the text inside."""

    tag: str
    lends: set[str] = field(default_factory=set)


class Paragraphs(HTMLParser):
    """Collects paragraphs.

    What an element lends (bold, italic, small, center, multicol, listitem, link) holds while it is
    open.  End tags close the nearest open element of their name and nothing else, for elements
    are left open and nested at will; centring by style or by a heading belongs to one paragraph.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[dict] = []
        self.open: list[Open] = []
        self.pieces: list[tuple[str, frozenset]] = []
        self.ruled = self.centred = False
        self.silent = 0

    def lent(self) -> frozenset:
        return frozenset().union(*(o.lends for o in self.open))

    def flush(self) -> None:
        pieces, self.pieces = self.pieces, []
        centred, self.centred = self.centred, False
        held = self.lent()
        runs: list[list] = []
        for text, has in pieces:
            style = ["bold" in has, "italic" in has]
            if not text.strip():  # space keeps words apart but has no style of its own
                if runs and not runs[-1][0].endswith(" "):
                    runs[-1][0] += " "
            elif runs and runs[-1][1:] == style:
                runs[-1][0] += text
            else:
                runs.append([text, *style])
        sizes = [(len(text.strip()), has) for text, has in pieces if text.strip()]
        total = sum(n for n, _ in sizes)
        if not total:
            return
        share = lambda what: sum(n for n, has in sizes if what in has)
        flags = {"center": centred or "center" in held, "multicol": "multicol" in held, "listitem": "listitem" in held, "after_rule": self.ruled, "link_only": share("link") >= total, "small": share("small") >= SMALL_SHARE * total}
        self.out.append({"runs": [dict(zip(("text", "bold", "italic"), r)) for r in runs]} | flags)

    def handle_starttag(self, tag, attrs):
        if tag in SILENT:
            self.silent += 1
            return
        if tag in BREAKS:
            self.flush()
        if tag == "hr":
            self.ruled = True
            return
        given = {k: v or "" for k, v in attrs}
        style = given.get("style", "")
        lends = {name for name, (*tags, css) in STYLES.items() if tag in tags or re.search(css, style)}
        lends |= {what for what, of in (("center", "center"), ("multicol", "multicol"), ("listitem", "li"), ("link", "a")) if tag == of}
        if tag == "font" and given.get("size", "").strip() in SMALL_SIZES:
            lends.add("small")
        if tag in BREAKS and (tag in HEADINGS or re.search(CENTRED, style)):
            self.centred = True
        if tag != "br":
            self.open.append(Open(tag, lends))

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
            return
        if tag in BREAKS:
            self.flush()
        for k in reversed(range(len(self.open))):
            if self.open[k].tag == tag:
                del self.open[k]
                break

    def handle_data(self, data):
        if not self.silent:
            self.pieces.append((re.sub(r"\s+", " ", data), self.lent()))

    def close(self):
        super().close()
        self.flush()


def paragraphs_of(markup: str | None) -> list[dict]:
    parser = Paragraphs()
    parser.feed(markup or "")
    parser.close()
    return parser.out


def paragraphs(df: DataFrame, markup: str) -> DataFrame:
    """One row for each paragraph: the other columns, para (its place), paragraph."""

    @F.pandas_udf(T.ArrayType(PARAGRAPH))
    def read(s: pd.Series) -> pd.Series:
        return s.map(paragraphs_of)

    keep = [c for c in df.columns if c != markup]
    return df.select(*keep, F.posexplode(read(markup)).alias("para", "paragraph"))


def paragraph_text(paragraph: Column) -> Column:
    """A paragraph's words, single-spaced."""
    return F.trim(F.regexp_replace(F.array_join(F.transform(paragraph["runs"], lambda r: r["text"]), ""), "(?U)\\s+", " "))


def italic_share(paragraph: Column) -> Column:
    """Share of characters set in italics, spaces at runs' ends aside; zero for an empty paragraph."""
    runs = paragraph["runs"]
    size = lambda r: F.length(F.trim(r["text"]))
    every = F.aggregate(runs, F.lit(0), lambda a, r: a + size(r))
    own = F.aggregate(runs, F.lit(0), lambda a, r: a + F.when(r["italic"], size(r)).otherwise(0))
    return F.when(every > 0, own / every).otherwise(0.0)


def declared_encoding(raw: bytes) -> str:
    """The encoding that a document names in its first bytes; Latin-1, and what is not known, is read as windows-1252."""
    found = re.search(rb'(?i)charset\s*=\s*"?([\w-]+)', raw[:2000])
    name = found[1].decode("ascii", "replace").lower().replace("_", "-") if found else LATIN1[0]
    try:
        "".encode(name)
    except LookupError:
        return "cp1252"
    return "cp1252" if name in LATIN1 else name


def decoded(raw: bytes | None) -> str | None:
    """A document's text; inverted marks drawn with brackets of a symbol font are mended."""
    if raw is None:
        return None
    text = raw.decode(declared_encoding(raw), "replace")
    return re.sub(INVERTED, lambda m: m[1] + ("¿" if m[2] == ")" else "¡"), text)


@F.pandas_udf(T.StringType())
def decode_html(s: pd.Series) -> pd.Series:
    """Documents' bytes as text, in the encoding that each declares."""
    return s.map(decoded)


def readable(markup: Column) -> Column:
    """Text without scripts and tags, single-spaced; scripts go first, since they may hold tags.  Entities stay."""
    out = F.regexp_replace(markup, "(?is)<(script|style)\\b.*?</\\1\\s*>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(out, "(?s)<[^>]*>", " "), "\\s+", " "))


def head_text(markup: Column, width: int = HEAD_CHARS) -> Column:
    """The beginning of a document as the masthead's rules read it: tags out, entities decoded, accents off, upper case."""
    from turnstone.functions.text import masthead

    return F.substring(masthead(unescaped(readable(markup))), 1, width)


@F.pandas_udf(T.StringType())
def unescaped(s: pd.Series) -> pd.Series:
    """Character references decoded."""
    return s.map(lambda x: None if x is None else html.unescape(x))


def links(markup: Column) -> Column:
    """Targets of links, in order."""
    return F.regexp_extract_all(markup, F.lit("(?i)<a\\b[^>]*?\\bhref\\s*=\\s*[\"']([^\"']*)[\"']"), 1)


def table_rows(df: DataFrame, markup: str) -> DataFrame:
    """Cells of table rows: the other columns, row, cells; rows without data cells are headers and go."""
    keep = [c for c in df.columns if c != markup]
    rows = df.select(*keep, F.posexplode(F.regexp_extract_all(F.col(markup), F.lit("(?is)<tr\\b[^>]*>(.*?)</tr>"), 1)).alias("row", "_row"))
    cells = F.transform(F.regexp_extract_all(F.col("_row"), F.lit("(?is)<td\\b[^>]*>(.*?)</td>"), 1), readable)
    return rows.select(*keep, "row", cells.alias("cells")).where(F.size("cells") > 0)
