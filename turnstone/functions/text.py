"""Text normal forms.

The native forms fold Latin letters with ``translate``, inside code generation; they are
exact for texts whose letters are ASCII or in ``ACCENTED``.  The ``exact_`` forms go
through Unicode data in Arrow batches and hold for all texts.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Latin letters with marks, and the letters without.
ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"
#: White space as Python and Unicode have it; Java's own class is ASCII only.
SPACE = "[\\s\\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"


def deaccent(c: Column) -> Column:
    return F.translate(c, ACCENTED, PLAIN)


def folded_case(c: Column) -> Column:
    """Lower case with the one Latin letter that folds to two."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def squeeze(c: Column) -> Column:
    """White space runs to one space, none at the ends."""
    return F.trim(F.regexp_replace(c, SPACE + "+", " "))


def resolver_key(c: Column) -> Column:
    """Accents off, single-spaced, case folded."""
    return folded_case(squeeze(deaccent(c)))


def observation_key(c: Column) -> Column:
    """Accents off, single-spaced, upper case."""
    return F.upper(squeeze(deaccent(c)))


def wording_key(c: Column) -> Column:
    """Lower case first, then accents off, single-spaced."""
    return squeeze(deaccent(F.lower(c)))


def letters_and_digits(c: Column) -> Column:
    """Only a-z and 0-9 stay: the form for containment tests."""
    return F.regexp_replace(deaccent(folded_case(c)), "[^0-9a-z]", "")


def letters_only(c: Column) -> Column:
    return F.regexp_replace(deaccent(folded_case(c)), "[^a-z]", "")


def as_read(c: Column) -> Column:
    """Folded without white space; punctuation stays."""
    return F.regexp_replace(deaccent(folded_case(c)), SPACE + "+", "")


def masthead(c: Column) -> Column:
    """Accents off, runs of space to one (ends kept), upper case."""
    return F.upper(F.regexp_replace(deaccent(c), SPACE + "+", " "))


def label_key(c: Column) -> Column:
    """A printed label: single-spaced, trailing terminators off, folded."""
    return folded_case(F.regexp_replace(squeeze(c), "[\\s.\\-–—−:]+$", ""))


def opening_key(c: Column, width: int = 300) -> Column:
    """The first words of a passage: leading punctuation off, single-spaced, folded, cut."""
    return F.substring(folded_case(squeeze(F.regexp_replace(c, "^[^\\p{L}\\p{N}_]+", ""))), 1, width)


def event_key(c: Column, width: int = 20) -> Column:
    """A note: leading dashes and brackets off, single-spaced, folded, cut."""
    return F.substring(folded_case(squeeze(F.regexp_replace(c, "^[\\s\\-–—−(\\[]+", ""))), 1, width)


def header_signature(c: Column) -> Column:
    """A running header without what changes from page to page."""
    return letters_only(c)


def cover_key(c: Column) -> Column:
    """Cover text: lower case, letter-spaced words closed up, single-spaced."""
    low = F.lower(deaccent(c))
    closed = F.regexp_replace(low, "\\b((?:[a-z]\\s){3,}[a-z])\\b", "\u0001$1\u0002")
    # Spaces between the marks go; a look-ahead finds those with an end mark first.
    return squeeze(F.regexp_replace(F.regexp_replace(closed, "(?<=[a-z])\\s(?=(?:[a-z]\\s)*[a-z]\u0002)", ""), "[\u0001\u0002]", ""))


def first_chars(c: Column, width: int = 60) -> Column:
    """Lower-case letters (with Spanish accents) and digits, cut."""
    return F.substring(F.regexp_replace(F.lower(c), "[^0-9a-záéíóúñ]", ""), 1, width)


def word_count(c: Column) -> Column:
    """White-space tokens; null stays null, a blank text has none."""
    t = squeeze(c)
    return F.when(c.isNull(), F.lit(None)).when(t == "", 0).otherwise(F.size(F.split(t, " "))).cast("long")


def _fold(text: str, form: str = "NFD") -> str:
    return "".join(ch for ch in unicodedata.normalize(form, text) if not unicodedata.combining(ch))


@F.pandas_udf(T.StringType())
def exact_resolver_key(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else " ".join(_fold(x).split()).casefold())


@F.pandas_udf(T.StringType())
def exact_observation_key(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else " ".join(_fold(x, "NFKD").upper().split()))


@F.pandas_udf(T.StringType())
def exact_letters_and_digits(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else re.sub("[^0-9a-z]", "", _fold(x.casefold())))


@F.pandas_udf(T.StringType())
def exact_as_read(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else "".join(_fold(x.casefold()).split()))
