"""Quality rules: a threshold table compiled into one Spark projection.

``measures`` builds every measure of a text as a column expression (lengths, symbols,
repeats, stop words, line shapes); ``RULES`` is the table of thresholds; ``verdict``
turns the table into one boolean expression.  No user functions, joins or shuffles:
a document's row holds all that its verdict needs.

A word is a run of characters other than space and the controls 9 to 13.

Repeated five-word windows: a window's key is a 64-bit hash of its words.  Texts
whose keys are all different (one hash set) are done; in others the keys are sorted
with their places, so that equal ones are neighbours and the cost stays n log n.

Cases: null and empty texts have no words and are rejected; repeated rows are judged
each on its own; a null id stays null; other columns are ignored by ``quality_rules``
and pass through ``keep_good`` unread, whatever their names; an empty table gives an
empty result; long texts are judged whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.llm._shared import held_back

SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]"
BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
WINDOW = 5

# Frequent function words of the languages served.
STOP_WORDS = (
    "the be to of and that have with in is it for on as at "
    "der die das und ist von zu den mit nicht ein eine auf "
    "le la les de et un une des du que est en dans pour "
    "el los las y que del por con una para no se"
).split()


@dataclass(frozen=True)
class Rule:
    """A measure, per what it is counted (None: as it is), and the bounds that a kept text meets.

    ``whole`` rounds the least down to a whole number, so that few words are not asked for a fraction of one.
    """

    measure: str
    per: str | None = None
    least: float | None = None
    most: float | None = None
    whole: bool = False


#: Ratios are multiplied out, so that no division by zero or rounding decides.
RULES = (
    Rule("n_words", None, 10, 10_000_000),
    Rule("word_chars", "n_words", 2, 14),
    Rule("n_symbols", "n_words", None, 0.1),
    Rule("n_exclaimed", "n_words", None, 0.5),
    Rule("n_upper", "word_chars", None, 0.5),
    Rule("n_letters", "word_chars", 0.5, None),
    Rule("n_repeat_words", "n_words", None, 0.2),
    Rule("n_dup_lines", "n_lines", None, 0.35),
    Rule("n_ellipsis_lines", "n_lines", None, 0.5),
    Rule("n_bullet_lines", "n_lines", None, 0.9),
    Rule("n_stop_words", "n_words", 0.005, None, True),
)


def words(text: Column) -> Column:
    trimmed = F.trim(text, F.expr(BLANKS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE + "+")).otherwise(F.array().cast("array<string>"))


def lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(x, F.expr(BLANKS))) > 0)


def measures(df: DataFrame, text: str = "text", only: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with its measures (``only`` some); helper columns begin with ``_q_``.

    The measures come out of a generator of one row, through which no filter is pushed:
    below it, each mention of a measure would be a copy of its whole expression.
    """
    columns = df.columns
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("_q_text", t)
    df = df.withColumns({"_q_words": words(F.col("_q_text")), "_q_lines": lines(F.col("_q_text"))})
    n = F.size("_q_words")
    df = df.withColumn(
        "_q_keys",
        F.when(n >= WINDOW, F.expr(f"transform(sequence(1, size(_q_words) - {WINDOW - 1}), i -> xxhash64(slice(_q_words, i, {WINDOW})))")).otherwise(F.array().cast("array<bigint>")),
    )
    # Texts without a repeat sort nothing.
    df = df.withColumn(
        "_q_sorted",
        F.when(F.size("_q_keys") != F.size(F.array_distinct("_q_keys")), F.expr("array_sort(transform(_q_keys, (k, i) -> struct(k AS k, i AS i)))")),
    )
    df = df.withColumn(
        "_q_places",
        F.expr("filter(_q_sorted, (x, j) -> x.k <=> get(_q_sorted, j - 1).k OR x.k <=> get(_q_sorted, j + 1).k)"),
    )
    long = lambda c: c.cast("long")
    count = lambda pattern: long(F.regexp_count("_q_text", F.lit(pattern)))
    found = {
        "n_words": long(n),
        "word_chars": long(F.length(F.array_join("_q_words", ""))),
        "n_symbols": count("[#*$%&|<>]"),
        "n_dup_lines": long(F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))),
        "n_repeat_words": long(F.coalesce(F.size(F.array_distinct(F.flatten(F.transform("_q_places", lambda x: F.sequence(x["i"], x["i"] + WINDOW - 1))))), F.lit(0))),
        "n_lines": long(F.size("_q_lines")),
        "n_ellipsis_lines": long(F.size(F.filter("_q_lines", lambda x: x.rlike("(\\.\\.\\.|…)\\s*$")))),
        "n_bullet_lines": long(F.size(F.filter("_q_lines", lambda x: x.rlike("^\\s*[-*•]")))),
        "n_exclaimed": count("!"),
        "n_upper": long(F.length("_q_text") - F.length(F.regexp_replace("_q_text", "\\p{Lu}+", ""))),
        "n_letters": long(F.length("_q_text") - F.length(F.regexp_replace("_q_text", "\\p{L}+", ""))),
        "n_stop_words": long(F.size(F.filter("_q_words", lambda w: w.isin(*dict.fromkeys(STOP_WORDS))))),
    }
    return held_back(df, [*columns, "_q_words"], {k: v for k, v in found.items() if not only or k in only})


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where every rule holds."""
    out = F.lit(True)
    for r in rules:
        unit = F.col(r.per) if r.per else F.lit(1)
        if r.least is not None:
            least = unit * F.lit(r.least)
            out = out & (F.col(r.measure) >= (F.floor(least) if r.whole else least))
        if r.most is not None:
            out = out & (F.col(r.measure) <= unit * F.lit(r.most))
    return out


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the measures, base_failed and kept for each row of ``docs`` (doc_id, text)."""
    df = measures(docs.select("doc_id", "text"))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return df.select("doc_id", *names, base.alias("base_failed"), (~base & verdict(rules)).alias("kept"), *[c for c in df.columns if c.startswith("n_") and c not in names])


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that meet the rules, with their own columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_q_row")
    df = measures(docs.select(row, F.col(text)), text)
    return df.where(verdict(rules)).select("_q_row.*")
