"""Ordered taxonomies: the first rule that matches names the class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(c: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The name of the first (name, pattern) that ``c`` matches."""
    out = None
    for name, pattern in rules:
        test = F.coalesce(c.rlike(pattern), F.lit(False))
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(F.lit(default))


def first_contained(c: Column, rules: list[tuple[str, list[str]]], default: str | None = None) -> Column:
    """The name of the first (name, keywords) of which ``c`` contains a keyword."""
    out = None
    for name, words in rules:
        test = F.lit(False)
        for w in words:
            test = test | F.coalesce(c.contains(w), F.lit(False))
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(F.lit(default))


def three_valued(c: Column, yes: str, no: str) -> Column:
    """True or false by the first pattern that matches; null where none does."""
    return F.when(c.rlike(yes), F.lit(True)).when(c.rlike(no), F.lit(False))


def honorific_is_feminine(label: Column) -> Column:
    """By the title; null for plurals and for labels without one."""
    low = F.lower(F.trim(label))
    return F.when(low.rlike("^(sra|srta)[.\\s]"), F.lit(True)).when(low.rlike("^sr[.\\s]"), F.lit(False))


def split_honorific(label: Column) -> tuple[Column, Column]:
    """The printed title and the name after it."""
    shape = "^\\s*((?i:sres|srta|sra|sr)\\.?)\\s*[.\\-]*\\s*(.*)$"
    title = F.regexp_extract(label, shape, 1)
    return F.nullif(title, F.lit("")), F.when(title == "", F.trim(label)).otherwise(F.trim(F.regexp_extract(label, shape, 2)))


def initials(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.substring(t, 1, 1))


def first_given(name: Column) -> Column:
    """The first token longer than two letters."""
    return F.get(F.filter(F.split(name, " "), lambda t: F.length(t) > 2), F.lit(0))


def given_matches(a: Column, b: Column) -> Column:
    """Names (normalised) share a token, or one is the initials that begin the other."""
    x = F.filter(F.split(F.translate(a, ".", " "), " "), lambda t: t != "")
    y = F.filter(F.split(b, " "), lambda t: t != "")
    short = F.forall(x, lambda t: F.length(t) == 1) & (F.size(x) > 0)
    heads = F.transform(x, lambda t: F.substring(t, 1, 1))
    return F.arrays_overlap(x, y) | (short & (heads == F.slice(initials(y), F.lit(1), F.size(x))))


def role_contains(haystack: Column, needle: Column) -> Column:
    """A whole phrase within another, on word edges in the Unicode sense."""
    return F.coalesce(F.regexp_like(haystack, F.concat(F.lit("(?U)(?<!\\w)\\Q"), needle, F.lit("\\E(?!\\w)"))) & (F.length(needle) > 0), F.lit(False))
