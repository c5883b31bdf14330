"""Record linkage: cascades of rules, each on what the one before left open."""

from __future__ import annotations

import difflib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _unique(pairs: DataFrame, probe: str, target: str, rung: str) -> DataFrame:
    """Probes whose pairs name one target only."""
    one = pairs.groupBy(probe).agg(F.countDistinct(target).alias("_n"), F.min(target).alias(target))
    return one.where("_n = 1").select(probe, target, F.lit(rung).alias("rung"))


def cascade_match(probes: DataFrame, targets: DataFrame, probe: str, key: str, target: str, name: str) -> DataFrame:
    """Exact name, then prefix on a word edge either way, then suffix; each rung needs one target.

    Prefix and suffix rungs are equi-joins: the shorter name is looked up among the
    word prefixes (suffixes) of the longer.
    """
    left, found = probes.select(probe, key), []

    def rest():
        return reduce(lambda df, f: df.join(f.select(probe), probe, "left_anti"), found, left)

    def heads(c: str) -> Column:
        words = F.split(c, " ")
        return F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))

    def tails(c: str) -> Column:
        words = F.split(c, " ")
        return F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, -n, n), " "))

    found.append(_unique(left.join(targets, F.col(key) == F.col(name)), probe, target, "exact"))
    a = rest().join(targets.select(target, F.explode(heads(name)).alias("_head")), F.col(key) == F.col("_head")).select(probe, target)
    b = rest().select(probe, F.explode(heads(key)).alias("_head")).join(targets, F.col("_head") == F.col(name)).select(probe, target)
    found.append(_unique(a.union(b), probe, target, "prefix"))
    c = rest().join(targets.select(target, F.explode(tails(name)).alias("_tail")), F.col(key) == F.col("_tail")).select(probe, target)
    found.append(_unique(c, probe, target, "suffix"))
    return reduce(DataFrame.unionByName, found)


def close_names(left: DataFrame, right: DataFrame, a: str, b: str, cutoff: float = 0.86) -> DataFrame:
    """Distinct pairs (a, b) of names whose matching-blocks ratio reaches the cutoff.

    Only distinct names are compared, and only pairs that can reach it: the ratio is at
    most twice the shorter length over both lengths, and names that reach 0.8 with three
    characters or more share two neighbouring ones.
    """
    grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda k: F.substring(c, k, F.lit(2))))
    own = left.select(F.col(a).alias("_a")).where("length(_a) > 1").distinct()
    others = right.select(F.col(b).alias("_b")).where("length(_b) > 1").distinct()
    pairs = own.select("_a", F.explode(grams(F.col("_a"))).alias("_g")).join(others.select("_b", F.explode(grams(F.col("_b"))).alias("_g")), "_g")
    near = pairs.select("_a", "_b").distinct().where(F.least(F.length("_a"), F.length("_b")) * (2 - cutoff) >= F.greatest(F.length("_a"), F.length("_b")) * cutoff)

    @F.pandas_udf(T.DoubleType())
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([difflib.SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y)])

    return near.where(ratio("_a", "_b") >= cutoff).select(F.col("_a").alias(a), F.col("_b").alias(b))


def fuzzy_match(probes: DataFrame, targets: DataFrame, probe: str, key: str, target: str, name: str, cutoff: float = 0.86) -> DataFrame:
    """Names close to each other, unique matches only."""
    got = probes.select(probe, key).join(close_names(probes, targets, key, name, cutoff), key).join(targets.select(target, name), name)
    return _unique(got, probe, target, "fuzzy")


def learned_flags(pairs: DataFrame, key: str, flag: str, weight: str, least: int = 4, share: float = 0.8) -> DataFrame:
    """Keys whose flag is settled: enough weight, and a share that is nearly all or nearly none."""
    sums = pairs.where(F.col(flag).isNotNull()).groupBy(key).agg(F.sum(weight).alias("n"), F.sum(F.when(F.col(flag), F.col(weight)).otherwise(0)).alias("_yes"))
    s = F.col("_yes") / F.col("n")
    return sums.where((F.col("n") >= least) & ((s >= share) | (s <= 1 - share))).select(key, "n", (s >= share).alias(flag))


def keep_settled(candidates: DataFrame, probe: str, known: Column, wanted: Column) -> DataFrame:
    """Candidates that agree with what a probe wants, unless any of the probe's is unsettled: then none."""
    w = Window.partitionBy(probe)
    return candidates.withColumn("_all", F.bool_and(known.isNotNull()).over(w)).where(F.col("_all") & (known == wanted)).drop("_all")


def break_ties(candidates: DataFrame, probe: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """The first rule that leaves exactly one candidate decides; the rule is reported."""
    out, left = [], candidates
    for name, test in rules:
        w = Window.partitionBy(probe)
        hit = left.withColumn("_n", F.count_if(test).over(w))
        out.append(hit.where((F.col("_n") == 1) & test).drop("_n").withColumn("decided_by", F.lit(name)))
        left = hit.where("_n <> 1").drop("_n")
    return reduce(DataFrame.unionByName, out)


def stepped_down(mandates: DataFrame, probes: DataFrame, key: str, day: str, begin: str, end: str) -> DataFrame:
    """Probes for which someone of that key ended before the day and nobody holds the key on it."""
    past = mandates.select(F.col(key), F.col(end).alias("_e")).where("_e IS NOT NULL")
    holds = mandates.select(F.col(key), F.col(begin).alias("_b"), F.col(end).alias("_e"))
    a = probes.join(past, (probes[key] == past[key]) & (past["_e"] < probes[day]), "left_semi")
    return a.join(holds, (a[key] == holds[key]) & (holds["_b"] <= a[day]) & (holds["_e"].isNull() | (holds["_e"] >= a[day])), "left_anti")
