"""Caucuses as of a day: readings near it, lives they must fit, brackets and deductions; and who an observation means."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstone.functions import fixed
from turnstone.functions.text import observation_key, resolver_key


def alive(readings: DataFrame, lives: DataFrame, caucus: str, day: str, into: str) -> DataFrame:
    """Adds whether the caucus lived that day: in one of its lives, or without any known (blank ends are open)."""
    spans = lives.groupBy(F.col("caucus").alias("_caucus")).agg(F.collect_list(F.struct(F.col("since"), F.col("until"))).alias("_spans"))
    inside = F.exists("_spans", lambda s: (s["since"].isNull() | (F.col(day) >= s["since"])) & (s["until"].isNull() | (F.col(day) <= s["until"])))
    return readings.join(spans, F.col(caucus) == F.col("_caucus"), "left").withColumn(into, F.col("_spans").isNull() | inside).drop("_caucus", "_spans")


def caucus_on(days: DataFrame, readings: DataFrame, lives: DataFrame, terms: DataFrame, near: int = fixed.NEAR_DAYS) -> DataFrame:
    """person, day, caucus, status, basis, observed, gap of each (person, day) of ``days``; null where nothing is known.

    ``readings``: person, date, caucus, status, basis; ``terms``: person, since, until (null: open).

    1. The nearest reading that is no deduction, within ``near`` days; ties to the earlier, then by caucus, status
       and basis.  A confirmed roll call that
       names a caucus not alive that day is anachronistic; else a confirmed reading is disputed if the last
       usable one up to the day and the first from it on, both near, differ in name.
    2. Beyond that, the same caucus in the nearest usable readings on both sides, inside one term: bracketed.
    3. Then the nearest deduction within reach and inside one term.
    Usable: confirmed, and no roll call of a caucus not alive that day.
    """
    keys = ["person", "day"]
    both = days.select(*keys).distinct().join(readings, "person")
    both = alive(both, lives, "caucus", "day", "lived").withColumns({"gap": F.abs(F.date_diff("date", "day")), "name": resolver_key(F.col("caucus"))})
    both = both.withColumn("usable", (F.col("status") == "confirmed") & ((F.col("basis") != "roll call") | F.col("lived")))
    held = terms.select(F.col("person").alias("_person"), F.col("since").alias("_since"), F.col("until").alias("_until"))
    spans = held.groupBy("_person").agg(F.collect_list(F.struct("_since", "_until")).alias("_terms"))
    both = both.join(spans, F.col("person") == F.col("_person"), "left").drop("_person")
    one_term = lambda a, b: F.coalesce(F.exists("_terms", lambda t: (t["_since"] <= a) & (t["_until"].isNull() | (b <= t["_until"]))), F.lit(False))
    # Readings of one day are told apart by all that they say, blanks last; an undated one is never near.
    said = [F.struct(F.col(c).isNull(), F.col(c)) for c in ("caucus", "status", "basis")]
    row, by_date, by_gap = F.struct("date", "caucus", "status", "basis", "name", "gap", "lived"), F.struct("date", *said), F.struct("gap", "date", *said)
    dated, reading, close, usable = F.col("gap").isNotNull(), F.col("status") != "deduced", F.col("gap") <= near, F.col("usable")
    up_to, onward = F.col("date") <= F.col("day"), F.col("date") >= F.col("day")
    deduced = (~reading) & close & one_term(F.least("date", "day"), F.greatest("date", "day"))
    got = both.groupBy(*keys).agg(
        F.min_by(row, F.when(reading & dated, by_gap)).alias("n"),
        F.max_by(row, F.when(usable & close & up_to, by_date)).alias("b"),
        F.min_by(row, F.when(usable & close & onward, by_date)).alias("a"),
        F.max_by(row, F.when(usable & up_to, by_date)).alias("bb"),
        F.min_by(row, F.when(usable & onward, by_date)).alias("aa"),
        F.min_by(row, F.when(deduced, by_gap)).alias("d"),
        F.first("_terms").alias("_terms"),
    )
    in_reach = F.coalesce(F.col("n.gap") <= near, F.lit(False))
    bracket = ~in_reach & F.coalesce((F.col("bb.name") == F.col("aa.name")) & one_term(F.col("bb.date"), F.col("aa.date")), F.lit(False))
    nearer = F.when(F.col("bb.gap") <= F.col("aa.gap"), F.col("bb")).otherwise(F.col("aa"))
    taken = F.when(in_reach, F.col("n")).when(bracket, nearer).otherwise(F.col("d"))
    confirmed = F.col("n.status") == "confirmed"
    status = F.when(in_reach & confirmed & (F.col("n.basis") == "roll call") & ~F.col("n.lived"), "anachronistic").when(in_reach & confirmed & F.coalesce(F.col("b.name") != F.col("a.name"), F.lit(False)), "disputed").when(bracket, "bracketed")
    got = got.withColumns({"_t": taken, "_s": status})
    out = got.select(*keys, F.col("_t.caucus").alias("caucus"), F.coalesce("_s", "_t.status").alias("status"), F.col("_t.basis").alias("basis"), F.col("_t.date").alias("observed"), F.col("_t.gap").alias("gap"))
    return days.select(*keys).distinct().join(out, keys, "left")


def name_parts(c: Column) -> Column:
    """A name's words, folded; hyphens and commas part like spaces."""
    return F.filter(F.split(F.translate(observation_key(c), "-,", "  "), " "), lambda x: x != "")


def person_of(observed: DataFrame, roster: DataFrame, given_first: bool = False) -> DataFrame:
    """Adds person and how to observed (printed, day), from roster (person, surname, given, since, until).

    In order, among those in office that day and then among all: the same full name (surname first), then a shared word of the surname and, if
    any is printed, of the given name; a rung decides only if it leaves one person.  With ``given_first`` the
    printed name has no comma, both kinds must share a word, and of several the one whose surname ends the name stays.
    """
    keys = observed.select("printed", "day").distinct()
    words = name_parts(F.col("printed"))
    if given_first:
        keys = keys.withColumns({"_surname": words, "_given": words})
    else:
        keys = keys.withColumns({"_surname": name_parts(F.split("printed", ",")[0]), "_given": name_parts(F.coalesce(F.get(F.split("printed", ","), F.lit(1)), F.lit("")))})
    people = roster.select("person", name_parts(F.col("surname")).alias("_s"), name_parts(F.col("given")).alias("_g"), observation_key(F.concat_ws(", ", "surname", "given")).alias("_full"), "since", "until")
    by_word = people.select("*", F.explode(F.array_distinct("_s")).alias("_word"))
    near = keys.select("*", F.explode(F.array_distinct("_surname")).alias("_word")).join(by_word, "_word")
    near = near.withColumn("_serving", (F.col("since") <= F.col("day")) & (F.col("until").isNull() | (F.col("until") >= F.col("day"))))
    full = observation_key(F.col("printed")) == F.col("_full")
    shared = (F.size("_given") == 0) | F.arrays_overlap("_given", "_g")
    ends = F.slice(F.reverse("_surname"), 1, F.size("_s")) == F.reverse(F.col("_s"))
    tests = [("exact name", full & F.lit(not given_first)), ("surname and given name", F.arrays_overlap("_given", "_g") if given_first else shared)]
    if given_first:
        tests.append(("surname and given name", F.arrays_overlap("_given", "_g") & ends & (F.size("_surname") > F.size("_s"))))
    rungs = [(f"{how}, {pool}", t & within) for pool, within in (("in office", F.col("_serving")), ("any date", F.lit(True))) for how, t in tests]
    found = near.groupBy("printed", "day").agg(*[F.collect_set(F.when(t, F.col("person"))).alias(f"_r{k}") for k, (_, t) in enumerate(rungs)])
    person = reduce(lambda out, k: out.when(F.size(f"_r{k}") == 1, F.get(f"_r{k}", F.lit(0))), range(len(rungs)), F.when(F.lit(False), F.lit(None)))
    how = reduce(lambda out, k: out.when(F.size(f"_r{k}") == 1, F.lit(rungs[k][0])), range(len(rungs)), F.when(F.lit(False), F.lit(None)))
    return observed.join(found.select("printed", "day", person.alias("person"), how.alias("how")), ["printed", "day"], "left")


def canonical_caucus(printed: Column) -> Column:
    """The key under which spellings of one caucus meet."""
    return F.regexp_replace(F.regexp_replace(F.translate(observation_key(printed), ".-", "  "), r"\s+", " "), "^BLOQUE ", "")


def roll_call_status(readings: DataFrame, lives: DataFrame, undated: DataFrame) -> DataFrame:
    """Adds reliability: 'anachronistic' where the caucus did not live that day, 'unchecked' where its lives are not known, else 'confirmed'."""
    out = alive(readings, lives, "caucus", "date", "_lived")
    out = out.join(undated.select(F.col("caucus").alias("_undated")).distinct(), F.col("caucus") == F.col("_undated"), "left")
    return out.withColumn("reliability", F.when(~F.col("_lived"), "anachronistic").when(F.col("_undated").isNotNull(), "unchecked").otherwise("confirmed")).drop("_lived", "_undated")


def session_facts(sessions: DataFrame, kinds: DataFrame, evidence: DataFrame) -> DataFrame:
    """Adds session_kind, quorum_failed, convened_as: from the label's own row, else (convened_as) from evidence; unmapped labels stay null."""
    label = F.trim(F.col("session_type"))
    own = kinds.select(F.trim("session_type").alias("_label"), "session_kind", (F.col("quorum_failed") == "true").alias("quorum_failed"), F.nullif("convened_as", F.lit("")).alias("_as"))
    said = evidence.select(F.col("session_id").alias("_id"), F.col("convened_as").alias("_said"))
    out = sessions.join(F.broadcast(own), label == F.col("_label"), "left").join(said, F.col("session_id") == F.col("_id"), "left")
    return out.withColumn("convened_as", F.when(F.col("_label").isNotNull(), F.coalesce("_as", "_said"))).drop("_label", "_as", "_id", "_said")


def deduced_from_counts(official: DataFrame, known: DataFrame, serving: DataFrame) -> DataFrame:
    """person, caucus: where all but one caucus of a day have as many known members as the official count, and the
    rest of those serving are as many as the last one lacks, the rest belong to it.

    ``official``: day, caucus, n; ``known``: day, person, caucus; ``serving``: day, person.
    """
    held = known.groupBy("day", "caucus").agg(F.count_distinct("person").alias("have"))
    lack = official.join(held, ["day", "caucus"], "left").withColumn("lack", F.col("n") - F.coalesce("have", F.lit(0)))
    w = Window.partitionBy("day")
    open_ones = lack.withColumns({"_open": F.sum((F.col("lack") > 0).cast("int")).over(w), "_over": F.min("lack").over(w)})
    last = open_ones.where((F.col("_open") == 1) & (F.col("lack") > 0) & (F.col("_over") >= 0)).select("day", "caucus", "lack")
    rest = serving.join(known.select("day", "person"), ["day", "person"], "left_anti").withColumn("_rest", F.count("*").over(w))
    return rest.join(last, "day").where(F.col("_rest") == F.col("lack")).select("day", "person", "caucus")
