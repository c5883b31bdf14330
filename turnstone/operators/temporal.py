"""As-of joins, spells, validity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_nearest(left: DataFrame, right: DataFrame, by: str, at: str, seen: str, value: str, tolerance: int) -> DataFrame:
    """Each left row (its id is ``probe``) with the reading nearest in days, within the tolerance.

    Ties go to the earlier reading, then to the smaller value.  Both sides are bucketed by
    the tolerance, so a key with many readings meets only those of three buckets, and left
    rows without a reading stay.
    """
    width = max(1, tolerance)
    number = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / width).cast("long")
    probes = left.select("probe", by, at).withColumn("_bucket", F.explode(F.array(*[number(F.col(at)) + k for k in (-1, 0, 1)])))
    readings = right.select(by, seen, value).withColumn("_bucket", number(F.col(seen)))
    gap = F.datediff(F.col(seen), F.col(at))
    pairs = probes.join(readings, [by, "_bucket"]).where(F.abs(gap) <= tolerance)
    best = pairs.groupBy("probe").agg(F.min(F.struct(F.abs(gap).alias("gap"), F.col(seen).alias("seen"), F.col(value).alias("value"))).alias("_best"))
    return left.join(best, "probe", "left").select(left["*"], F.col("_best.seen").alias("seen"), F.col("_best.value").alias("value"), F.col("_best.gap").alias("gap"))


def before_and_after(left: DataFrame, right: DataFrame, by: str, at: str, seen: str, value: str) -> DataFrame:
    """Each left row with the last reading up to its day and the first from it on; a reading of the day is both.

    One union and two windows: no pairs are made.
    """
    reading = F.struct(F.col(seen).alias("seen"), F.col(value).alias("value"))
    day = right.groupBy(by, seen).agg(F.max(reading).alias("_last"), F.min(reading).alias("_first"))
    rows = left.select(by, F.col(at).alias("_day"), "probe", F.lit(None).cast(day.schema["_last"].dataType).alias("_last"), F.lit(None).cast(day.schema["_first"].dataType).alias("_first"))
    both = rows.unionByName(day.select(by, F.col(seen).alias("_day"), F.lit(None).cast(left.schema["probe"].dataType).alias("probe"), "_last", "_first"))
    w = Window.partitionBy(by).orderBy("_day")
    got = both.withColumns({"before": F.last("_last", True).over(w.rangeBetween(Window.unboundedPreceding, 0)), "after": F.first("_first", True).over(w.rangeBetween(0, Window.unboundedFollowing))})
    return got.where("probe IS NOT NULL").select("probe", "before", "after")


def spells(df: DataFrame, by: str, order: Sequence[str], value: str, at: str) -> DataFrame:
    """Runs of equal consecutive values; a null ends a run and is none."""
    w = Window.partitionBy(by).orderBy(*order)
    flagged = df.withColumn("_new", (~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("int"))
    numbered = flagged.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.where(F.col(value).isNotNull()).groupBy(by, "_run", value).agg(F.min(at).alias("begin"), F.max(at).alias("end"), F.count("*").alias("n")).drop("_run")


def clipped(spell: DataFrame, lives: DataFrame, value: str) -> DataFrame:
    """Spells cut to the lives of their value (open bounds null).

    What lies before a life goes to its predecessor, who shares the boundary day; values
    without lives pass through.
    """
    s = spell.alias("s").join(lives.alias("l"), value, "left")
    lo = F.greatest("s.begin", F.col("l.life_begin"))
    hi = F.least("s.end", F.col("l.life_end"))
    keep = [c for c in spell.columns if c not in (value, "begin", "end")]
    own = s.select(*[f"s.{c}" for c in keep], F.col(value), lo.alias("begin"), hi.alias("end")).where("begin <= end")
    earlier = s.where("l.predecessor IS NOT NULL AND l.life_begin IS NOT NULL AND s.begin < l.life_begin")
    before = earlier.select(*[f"s.{c}" for c in keep], F.col("l.predecessor").alias(value), F.col("s.begin").alias("begin"), F.least("s.end", F.col("l.life_begin")).alias("end"))
    return own.unionByName(before)


def in_window(begin: Column, end: Column, day: Column, grace: int = 0) -> Column:
    """Within an interval whose null bounds are open; grace moves the beginning only."""
    return (begin.isNull() | (F.date_sub(begin, grace) <= day)) & (end.isNull() | (day <= end))


def alive(probes: DataFrame, lives: DataFrame, by: str, day: str) -> DataFrame:
    """Whether a life covers the day; a value without lives is alive."""
    flag = F.coalesce(F.bool_or(in_window(F.col("life_begin"), F.col("life_end"), F.col(day))), F.lit(True))
    known = F.max(F.col("_life").isNotNull())
    got = probes.join(lives.withColumn("_life", F.lit(1)), by, "left").groupBy(*probes.columns).agg(flag.alias("_flag"), known.alias("_known"))
    return got.withColumn("alive", F.when(F.col("_known"), F.col("_flag")).otherwise(True)).drop("_flag", "_known")
