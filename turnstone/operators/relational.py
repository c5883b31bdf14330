"""Joins, aggregates, set operations, sampling and checks of tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def enrich(fact: DataFrame, dimension: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left equi-join; Spark broadcasts the dimension if it is small enough."""
    return fact.join(dimension, list(on), "left")


def strict_lookup(fact: DataFrame, dimension: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """Left lookup that fails on a key the dimension lacks."""
    got = enrich(fact, dimension, on)
    message = F.concat(F.lit("no entry for "), F.concat_ws(", ", *[F.col(c).cast("string") for c in on]))
    return got.withColumn(value, F.when(F.col(value).isNull(), F.raise_error(message)).otherwise(F.col(value)))


def pivot_sum(df: DataFrame, row: str, column: str, values: Sequence[str], amount: Column, names: Sequence[str]) -> DataFrame:
    """Sums by row for a fixed list of columns; an absent value is zero."""
    sums = [F.coalesce(F.sum(F.when(F.col(column) == v, amount)), F.lit(0)).alias(n) for v, n in zip(values, names)]
    return df.groupBy(row).agg(*sums)


def distinct_per(df: DataFrame, row: str, column: str, values: Sequence[str], counted: str, names: Sequence[str], total: str) -> DataFrame:
    """Distinct counts by row and column, and over all columns."""
    return df.groupBy(row).agg(*[F.countDistinct(F.when(F.col(column) == v, F.col(counted))).alias(n) for v, n in zip(values, names)], F.countDistinct(counted).alias(total))


def share_within(df: DataFrame, group: str, part: str, amount: Column, out: str, digits: int = 6) -> DataFrame:
    """Each part's percentage of its group's total."""
    sums = df.groupBy(group, part).agg(F.sum(amount).alias("_sum"))
    whole = F.sum("_sum").over(Window.partitionBy(group))
    return sums.select(group, part, F.round(100 * F.col("_sum").cast("double") / whole.cast("double"), digits).alias(out))


def share_of_total(df: DataFrame, part: str, amount: Column, out: str, digits: int = 6) -> DataFrame:
    """Each part's percentage of everything; the total is one more aggregate, not a one-task window."""
    sums = df.groupBy(part).agg(F.sum(amount).alias("_sum"))
    whole = df.agg(F.sum(amount).alias("_whole"))
    return sums.join(F.broadcast(whole)).select(part, F.round(100 * F.col("_sum").cast("double") / F.col("_whole").cast("double"), digits).alias(out))


def rate_from(base: DataFrame, hits: DataFrame, key: str, n: str, d: str, per: float, out: str) -> DataFrame:
    """Hits per so many of the base; a key without hits has no rate (null, not zero)."""
    return base.join(hits, key, "left").select(key, F.round(F.col(n) * F.lit(per) / F.col(d), 6).alias(out))


def top_with_span(df: DataFrame, key: str, amount: Column, moment: Column, k: int) -> DataFrame:
    """The k keys with the largest sums, and their first and last moment."""
    agg = df.groupBy(key).agg(F.sum(amount).alias("total"), F.min(moment).alias("first"), F.max(moment).alias("last"))
    return agg.orderBy(F.col("total").desc(), key).limit(k)


def quantiles(df: DataFrame, group: str, value: str, points: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Exact quantiles with linear interpolation."""
    got = df.groupBy(group).agg(F.percentile(value, [float(p) for p in points]).alias("_q"))
    return got.select(group, *[F.col("_q")[k].alias(n) for k, n in enumerate(names)])


def mode_first(df: DataFrame, group: str, value: str, order: str) -> DataFrame:
    """The most frequent value of each group; of equals that which comes first."""
    counts = df.groupBy(group, value).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    return counts.groupBy(group).agg(F.max_by(value, F.struct(F.col("n"), -F.col("_first"))).alias("mode"), F.max("n").alias("n"))


def broken_dependencies(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value."""
    return df.groupBy(key).agg(F.countDistinct(value).alias("n_values")).where("n_values > 1")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """New rows win; columns that one side lacks are null."""
    return old.join(new.select(*key), list(key), "left_anti").unionByName(new, allowMissingColumns=True)


def missing_and_extra(listed: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """Keys that are listed and not held, and the other way round."""
    a, b = listed.select(key).distinct(), held.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("missing")).union(b.join(a, key, "left_anti").withColumn("side", F.lit("extra")))


def reconcile(ours: DataFrame, theirs: DataFrame, key: str) -> DataFrame:
    """Counts by key on both sides, and the difference."""
    a, b = ours.groupBy(key).agg(F.count("*").alias("ours")), theirs.groupBy(key).agg(F.count("*").alias("theirs"))
    both = a.join(b, key, "full_outer").na.fill(0, ["ours", "theirs"])
    return both.withColumn("difference", F.col("ours") - F.col("theirs"))


def union_all(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def multiset_overlap(a: DataFrame, b: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Size of the multiset intersection, in all or for each of ``by``."""
    x = a.groupBy(*by, *keys).agg(F.count("*").alias("_x"))
    y = b.groupBy(*by, *keys).agg(F.count("*").alias("_y"))
    both = x.join(y, [*by, *keys])
    return (both.groupBy(*by) if by else both).agg(F.coalesce(F.sum(F.least("_x", "_y")), F.lit(0)).alias("overlap"))


def precision_recall(tp: Column, found: Column, gold: Column, digits: int = 6) -> list[Column]:
    """Micro precision, recall and F1; empty denominators count as one."""
    p, r = tp / F.greatest(found, F.lit(1)), tp / F.greatest(gold, F.lit(1))
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return [F.round(p, digits).alias("precision"), F.round(r, digits).alias("recall"), F.round(f1, digits).alias("f1")]


def agreement(shared: Column, a: Column, b: Column, digits: int = 6) -> Column:
    """Twice the shared over the sum of both."""
    return F.round(F.when(a + b > 0, 2 * shared / (a + b)).otherwise(1.0), digits)


def stable_sample(df: DataFrame, stratum: str, keys: Sequence[str], salt: str, k: int) -> DataFrame:
    """The k rows of each stratum whose salted digest is smallest: the same for any order of the input."""
    digest = F.sha2(F.concat_ws("|", F.lit(salt), *[F.col(c).cast("string") for c in keys]), 256)
    w = Window.partitionBy(stratum).orderBy("_digest", *keys)
    return df.withColumn("_digest", digest).withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_digest", "_rank")


def occurrence(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Which of how many a row is among rows of equal key."""
    w = Window.partitionBy(*key)
    return df.withColumns({"nth": F.row_number().over(w.orderBy(*order)), "of": F.count("*").over(w)})


def exact_groups(df: DataFrame, key: str, text: str) -> DataFrame:
    """Groups of equal texts by digest: size and smallest key."""
    return df.groupBy(F.sha2(F.col(text), 256).alias("digest")).agg(F.count("*").alias("n"), F.min(key).alias("first")).where("n > 1")
