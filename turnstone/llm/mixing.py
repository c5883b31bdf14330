"""Soft-membership mixing of documents to target weights, in DataFrame functions only.

A classifier learned from a labelled table gives each document a posterior over
domains.  Rates r >= 0 are then fitted by projected-gradient least squares: the expected
tokens of each domain, sum of r * tokens * posterior, come closest to the targets, and
among rates that do so those nearest to 1 are taken (a weight ``closeness`` on the
tokens' squared distance from rate 1 makes the solution unique).

The classifier is naive Bayes over shape measures (Gaussian) and over how many different
words typical of a domain a text holds (Poisson, by the text's length); the typical words
are learned too, by count: those that ``least`` labelled texts of the domain hold and that are
``ratio`` times as frequent there as elsewhere.  It is fitted on at most ``labelled_limit``
labelled rows, those of smallest hashed id.

The gradient of all rates lies in the span of the posteriors, so the rates are the
projection onto r >= 0 of 1 plus the documents' posteriors times one number for each
domain, in which all steps add up.  A step is one aggregate over the small table of tokens
and posteriors; it is conditioned by the Gram matrix of the documents whose rate is not
zero and halved until the objective falls.  Steps end when the gradient is below
``TOLERANCE`` of the budget; ``fit`` returns what was aimed at and reached, and ``rates``
warns if a target is missed by more than ``MISSED`` of the budget (no rates meet it, or 200 steps did not).  No rates are stored or sent.

Cases: null and empty texts have no tokens and a posterior like any other text;
domains without labels do not exist, and without labels all documents are of one
domain and have rate 1; a domain that targets do not name has target 0; ids that
labels repeat count once; repeated rows have equal rates; a null id stays null; other
columns are ignored by ``rates`` and pass through ``mixed`` unread; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
import warnings
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.llm._shared import BROADCAST_ROWS, Scratch, held_back
from turnstone.llm.quality import measures

LABELLED_LIMIT = 20_000
#: A typical word is in so many labelled texts of its domain, and so many times as frequent there as elsewhere; the most frequent so many are taken.
TYPICAL_LEAST, TYPICAL_RATIO, TYPICAL_WORDS = 4, 8.0, 20_000
CLOSENESS, TOLERANCE, MISSED, STEPS = 1e-5, 1e-9, 0.005, 200
#: Of the labelled table's domains.
TARGETS = {"clean": 0.95, "rough": 0.05, "toxic": 0.0}


#: Kinds that the labels (quality, toxic) tell apart, and their domains.  A domain is the mixture of its kinds.
DOMAIN_OF = {"good": "clean", "poor": "rough", "good toxic": "toxic", "poor toxic": "toxic"}


def kinds_of(labels: DataFrame) -> DataFrame:
    """doc_id, kind of the table of labels (doc_id, quality, toxic)."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    one = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return one.select("doc_id", F.concat(F.when(F.col("quality") == 1, "good").otherwise("poor"), F.when(F.col("toxic") == 1, " toxic").otherwise("")).alias("kind"))


def plain_words() -> Column:
    """Lower-cased words without punctuation, each once."""
    return F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), "[\\s.,;:!?\"'()\\[\\]]+"))


def shape_columns() -> dict[str, Column]:
    """Measures of a text's shape that are near to normal within a domain."""
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return {
        "f_symbols": F.log1p(100 * F.col("n_symbols") / n),
        "f_exclaimed": F.log1p(100 * F.col("n_exclaimed") / n),
        "f_upper": F.col("n_upper") / chars,
        "f_letters": F.col("n_letters") / chars,
        "f_length": F.col("word_chars") / n,
        "f_repeated": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
    }


#: Spreads are at least this, so that a measure that never varies among the labelled does not decide alone.
LEAST_SPREAD = {"f_symbols": 0.3, "f_exclaimed": 0.3, "f_upper": 0.05, "f_letters": 0.05, "f_length": 0.5, "f_repeated": 0.1}


NEEDED = ("n_words", "word_chars", "n_symbols", "n_exclaimed", "n_upper", "n_letters", "n_dup_lines", "n_lines")


def described(docs: DataFrame, *keep: str | Column) -> DataFrame:
    return measures(docs.select(*keep, "text"), only=NEEDED).withColumns(shape_columns())


class Classifier:
    """Naive Bayes whose parameters are numbers in column expressions."""

    def __init__(self, docs: DataFrame, labelled: DataFrame, domain_of: dict[str, str], limit: int, scratch: Scratch):
        sample = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
        held = described(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "kind"), "doc_id", "kind")
        held = scratch.save(held.select("kind", "n_words", *shape_columns(), plain_words().alias("words")), "labelled")
        stats = held.groupBy("kind").agg(F.count("*").alias("n"), F.sum("n_words").alias("n_words"), *[f(c).alias(f"{c}_{k}") for c in shape_columns() for k, f in (("mean", F.avg), ("sd", F.stddev_pop))]).collect()
        self.stats = {r["kind"]: r for r in sorted(stats, key=lambda r: r["kind"])}
        self.domain_of = {k: domain_of[k] for k in self.stats}
        self.domains = sorted(set(self.domain_of.values()))
        total = sum(r["n"] for r in stats)
        size = {d: sum(r["n"] for k, r in self.stats.items() if self.domain_of[k] == d) for d in self.domains}
        long = {d: sum(r["n_words"] for k, r in self.stats.items() if self.domain_of[k] == d) for d in self.domains}
        self.prior = {k: r["n"] / total for k, r in self.stats.items()}
        self.typical: dict[str, list[str]] = {}
        self.hits: dict[tuple[str, str], float] = {}
        if len(self.domains) < 2:
            return
        of = F.create_map(*[F.lit(x) for kd in sorted(self.domain_of.items()) for x in kd])[F.col("kind")]
        each = held.select(of.alias("domain"), F.explode("words").alias("word")).where("word <> ''")
        counts = scratch.save(each.groupBy("word").agg(*[F.count_if(F.col("domain") == d).alias(f"n{k}") for k, d in enumerate(self.domains)]), "words")
        every = reduce(lambda a, b: a + b, [F.col(f"n{k}") for k in range(len(self.domains))])
        for k, d in enumerate(self.domains):
            others = (every - F.col(f"n{k}") + 0.5) / (total - size[d] + 1)
            found = counts.where((F.col(f"n{k}") >= TYPICAL_LEAST) & (F.col(f"n{k}") / size[d] >= TYPICAL_RATIO * others)).orderBy(F.col(f"n{k}").desc(), "word").limit(TYPICAL_WORDS)
            if words := [r["word"] for r in found.select("word").collect()]:
                self.typical[d] = words
        if self.typical:
            for r in held.withColumn("domain", of).groupBy("domain").agg(*[F.sum(self._held("words", w)).alias(f"hit_{d}") for d, w in self.typical.items()]).collect():
                for d in self.typical:
                    self.hits[r["domain"], d] = (r[f"hit_{d}"] + 0.5) / (long[r["domain"]] + 1)

    @staticmethod
    def _held(column: str, words: list[str]) -> Column:
        return F.size(F.filter(column, lambda w: w.isin(words)))

    def posteriors(self, df: DataFrame) -> DataFrame:
        """``df`` (from ``described``) with p_<domain>."""
        if not self.domains:
            return df.withColumn("p_all", F.lit(1.0))
        columns = df.columns
        if self.typical:
            df = df.withColumn("_q_plain", plain_words())
            df = df.withColumns({f"_q_hit_{k}": self._held("_q_plain", w) for k, w in enumerate(self.typical.values())})
        logs = {}
        for n, kind in enumerate(self.stats):
            out = F.lit(math.log(self.prior[kind]))
            for c in shape_columns():
                mean, sd = self.stats[kind][f"{c}_mean"], max(self.stats[kind][f"{c}_sd"] or 0.0, LEAST_SPREAD[c])
                z = (F.col(c) - mean) / sd
                out = out - z * z / 2 - math.log(sd)
            for j, other in enumerate(self.typical):
                rate = self.hits[self.domain_of[kind], other]
                out = out + F.col(f"_q_hit_{j}") * math.log(rate) - F.col("n_words") * rate
            logs[f"_q_log_{n}"] = out
        df = df.withColumns(logs)
        most = F.greatest(*logs) if len(logs) > 1 else F.col("_q_log_0")
        df = df.withColumn("_q_most", most).withColumns({f"_q_e_{k}": F.exp(F.col(f"_q_log_{k}") - F.col("_q_most")) for k in range(len(logs))})
        add = lambda own: reduce(lambda a, b: a + b, own)
        total = add([F.col(f"_q_e_{k}") for k in range(len(logs))])
        return held_back(df, columns, {f"p_{d}": add([F.col(f"_q_e_{k}") for k, kind in enumerate(self.stats) if self.domain_of[kind] == d]) / total for d in self.domains})

    def columns(self) -> list[str]:
        return [f"p_{d}" for d in self.domains] or ["p_all"]


def fitted(table: DataFrame, columns: list[str], targets: dict[str, float], budget: float | None = None, closeness: float = CLOSENESS) -> tuple[Column, dict]:
    """The rate as an expression over tokens and posteriors, and what the fit came to.

    Without a ``budget`` (total tokens) it is as large as the domain with the largest
    target allows at rate 1.
    """
    tokens = F.col("n_tokens")
    sums = table.agg(*[F.sum(tokens * F.col(c)).alias(c) for c in columns]).first()
    held = {c: float(sums[c] or 0.0) for c in columns}
    weight = {c: float(targets.get(c.removeprefix("p_"), 0.0)) for c in columns}
    if columns == ["p_all"] or not any(weight.values()) or not any(held.values()):
        return F.lit(1.0), {"held": held, "aim": held, "reached": held, "steps": 0, "met": True}
    total = sum(weight.values())
    lead = max((c for c in columns if held[c] > 0), key=lambda c: weight[c])
    budget = budget if budget is not None else held[lead] * total / weight[lead] if weight[lead] else sum(held.values())
    live = [c for c in columns if held[c] > 0]
    aim = np.array([budget * weight[c] / total for c in live])
    pairs = [(i, j) for i in range(len(live)) for j in range(i, len(live))]

    def rate_of(at: np.ndarray) -> Column:
        return F.greatest(F.lit(0.0), reduce(lambda a, b: a + b, [F.col(c) * float(x) for c, x in zip(live, at)], F.lit(1.0)))

    def measured(at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Objective, gradient, Gram matrix of what is not zero, and the domains' totals at these numbers."""
        rated = table.withColumn("_q_rate", rate_of(at))
        on = F.when(F.col("_q_rate") > 0, tokens).otherwise(0)
        got = rated.agg(F.sum(tokens * F.col("_q_rate") * F.col("_q_rate")), *[F.sum(tokens * F.col("_q_rate") * F.col(c)) for c in live], *[F.sum(on * F.col(live[i]) * F.col(live[j])) for i, j in pairs]).first()
        reached, gram = np.array(got[1 : 1 + len(live)], float), np.zeros((len(live),) * 2)
        for (i, j), x in zip(pairs, got[1 + len(live) :]):
            gram[i, j] = gram[j, i] = x
        pull = closeness * budget
        return float(got[0]) / 2 - aim @ at + pull * (at @ at) / 2, reached - aim + pull * at, gram + pull * np.eye(len(live)), reached

    at, steps = np.zeros(len(live)), 0
    value, slope, gram, reached = measured(at)
    while np.abs(slope).max() > TOLERANCE * budget and steps < STEPS:
        move, size = -np.linalg.solve(gram, slope), 1.0
        while True:
            tried = measured(at + size * move)
            steps += 1
            if tried[0] <= value + 1e-4 * size * (slope @ move) or size < 1e-6:
                break
            size /= 2
        if size < 1e-6:  # no further fall can be told from rounding
            break
        at, (value, slope, gram, reached) = at + size * move, tried
    missed = np.abs(reached - aim).max() / budget
    return rate_of(at), {"held": held, "aim": dict(zip(live, aim.tolist())), "reached": dict(zip(live, reached.tolist())), "steps": steps, "converged": bool(np.abs(slope).max() <= 1e-6 * budget), "missed": float(missed), "met": bool(missed <= MISSED)}


def told(report: dict) -> None:
    if not report["met"]:
        warnings.warn(f"the documents cannot meet the targets: aim {report['aim']}, reached {report['reached']}", stacklevel=3)


def fit(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, labelled_limit: int = LABELLED_LIMIT, budget: float | None = None, closeness: float = CLOSENESS) -> tuple[DataFrame, dict]:
    """doc_id, n_tokens (words), p_<domain>, rate of every row of ``docs`` (doc_id, text); and the fit's report."""
    scratch = Scratch(docs.sparkSession, "mixing")
    model = Classifier(docs, kinds_of(labels), DOMAIN_OF, labelled_limit, scratch)
    table = model.posteriors(described(docs, "doc_id")).select("doc_id", F.col("n_words").alias("n_tokens"), *model.columns())
    table = scratch.save(table, "posteriors")
    rate, report = fitted(table, model.columns(), targets, budget, closeness)
    return table.withColumn("rate", rate), report


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, labelled_limit: int = LABELLED_LIMIT, budget: float | None = None, closeness: float = CLOSENESS) -> DataFrame:
    """``fit`` without its report; warns if the targets are missed."""
    table, report = fit(docs, labels, targets, labelled_limit, budget, closeness)
    told(report)
    return table


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float], labelled_limit: int = LABELLED_LIMIT, closeness: float = CLOSENESS) -> DataFrame:
    """The rows of ``docs`` whose rate rounds to one or more, with their own columns; none is repeated.

    Posteriors are computed once, beside a hash of each row's id and text; rows equal in both have one rate.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    model = Classifier(docs, kinds_of(labels), DOMAIN_OF, labelled_limit, scratch)
    name = F.xxhash64("doc_id", "text")
    judged = model.posteriors(described(docs, name.alias("_q_name"))).select("_q_name", F.col("n_words").alias("n_tokens"), *model.columns())
    table = scratch.save(judged, "posteriors")
    rate, _ = fitted(table, model.columns(), targets, closeness=closeness)
    gone = scratch.save(table.where(rate < 0.5).select("_q_name").distinct(), "gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone.hint("merge")
    return docs.join(gone, name == F.col("_q_name"), "left_anti")
