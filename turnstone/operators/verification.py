"""Recorded readings asked again: what a record quotes, whom it names, and whether that still holds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnstone.functions.text import letters_and_digits

# Traces of later repairs, a label's end with letters of the speech after it, window and least key.
REPAIRED = "\\(cid:\\d+\\)|[\\x{E000}-\\x{F8FF}]|(?<=\\d)E\\b"
GLUED_TAIL = "^(.*[.\\-–—−─])\\s*[A-Za-zÁÉÍÓÚÑáéíóúñ]{1,2}$"
WINDOW, LEAST_KEY = 24, 12


def search_key(quoted: Column) -> Column:
    """The longest stretch of the quoted words that no repair touched (the first of equals), as letters and digits."""
    stretches = F.transform(F.split(F.coalesce(quoted, F.lit("")), REPAIRED), letters_and_digits)
    ranked = F.transform(stretches, lambda s, k: F.struct(F.length(s).alias("n"), (-k).alias("place"), s.alias("key")))
    return F.array_max(ranked)["key"]


def search_windows(key: Column, width: int = WINDOW) -> Column:
    """Windows at the beginning, in the middle and at the end; a short key is its own."""
    n = F.length(key)
    starts = F.array_distinct(F.array(F.lit(0), F.floor((n - width) / 2).cast("int"), n - width))
    return F.when(n < width, F.array(key)).otherwise(F.transform(starts, lambda s: F.substring(key, s + 1, F.lit(width))))


def same_person(recorded: Column, found: Column) -> Column:
    """Equal as letters and digits, or so once letters glued after the recorded label's end are off."""
    said, cut = F.coalesce(recorded, F.lit("")), F.regexp_extract(F.trim(recorded), GLUED_TAIL, 1)
    seen = letters_and_digits(F.coalesce(found, F.lit("")))
    return (letters_and_digits(said) == seen) | F.coalesce((cut != "") & (letters_and_digits(cut) == seen), F.lit(False))


def verdict(recorded: Column, found: Column) -> Column:
    """Of all labels that now carry the passage: holds, several names, or changed; null where none does."""
    same = lambda f: same_person(recorded, f)
    return (
        F.when(F.coalesce(F.size(found), F.lit(0)) < 1, F.lit(None).cast("string"))
        .when(F.forall(found, same), "holds")
        .when(F.exists(found, same), "several")
        .otherwise("changed")
    )
