"""From printed labels to people: the decision list, as joins on what each shape of label states.

Inputs
    labels: label, day, session, session_type, presiding (array of names; null where none is known); a row for each passage
    mandates: person_id, surname, given, party, province, begin, end, load_order
    officers: person_id, name, keys (array), role_stem, category, begin, end, curated, load_order
    gender (optional): given, feminine

Sittings of one day are kept apart by ``session`` (null counts as the empty name), since each has its own type and chair.
Only distinct (label, day, session) are resolved; candidates come from equi-joins on words of
names, never from comparing all labels with all people.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstone.functions import labels as L
from turnstone.functions.taxonomy import first_given, given_matches, honorific_is_feminine, initials
from turnstone.functions.text import resolver_key
from turnstone.operators.linkage import close_names, learned_flags
from turnstone.operators.temporal import in_window
from turnstone.session import cut

PROBE = ["label", "day", "session"]


def _words(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda w: w != "")


def _phrases(c: Column) -> Column:
    """All runs of words of a name."""
    w = _words(c)
    upto = lambda i: F.transform(F.sequence(F.lit(1), F.size(w) - i), lambda n: F.array_join(F.slice(w, i + 1, n), " "))
    return F.when(F.size(w) > 0, F.flatten(F.transform(F.sequence(F.lit(0), F.size(w) - 1), upto))).otherwise(F.array().cast("array<string>"))


def _heads(c: Column) -> Column:
    """Beginnings of a name that are shorter than it, on word edges."""
    return F.filter(_phrases(c), lambda p: (F.length(p) < F.length(c)) & F.startswith(c, F.concat(p, F.lit(" "))))


def _tails(c: Column) -> Column:
    return F.filter(_phrases(c), lambda p: (F.length(p) < F.length(c)) & F.endswith(c, F.concat(F.lit(" "), p)))


def _rungs(name: Column, *of: tuple[int, Column]) -> Column:
    """Array of (lookup, rung): the name itself, then what ``of`` lists."""
    one = lambda n: lambda p: F.struct(p.alias("lookup"), F.lit(n).alias("rung"))
    return F.concat(F.transform(F.array(name), one(1)), *[F.transform(a, one(n)) for n, a in of])


def _lowest(df: DataFrame, by: tuple[str, ...] = tuple(PROBE)) -> DataFrame:
    w = Window.partitionBy(*by)
    return df.withColumn("_low", F.min("rung").over(w)).where("rung = _low").drop("_low")


def _valid(grace: Column) -> Column:
    day = F.col("day")
    return (F.col("begin").isNull() | (F.date_sub(F.col("begin"), grace) <= day)) & (F.col("end").isNull() | (day <= F.col("end")))


def _given_asked(given: Column) -> Column:
    """What a printed given name is looked up by: its words, and if all are initials those as one."""
    words = _words(F.translate(given, ".", " "))
    short = F.forall(words, lambda t: F.length(t) == 1) & (F.size(words) > 0)
    letters = F.when(short, F.array(F.concat(F.lit("initials "), F.array_join(words, "")))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.transform(words, lambda t: F.concat(F.lit("word "), t)), letters))


def _given_held(given: Column) -> Column:
    """What a member's given names answer to: their words, and all beginnings of their initials."""
    words = _words(given)
    heads = F.transform(words, lambda _, k: F.concat(F.lit("initials "), F.array_join(initials(F.slice(words, F.lit(1), k + 1)), "")))
    return F.array_distinct(F.concat(F.transform(words, lambda t: F.concat(F.lit("word "), t)), heads))


def member_candidates(probes: DataFrame, mandates: DataFrame) -> DataFrame:
    """Members a label can mean: the first rung that has any (exact, prefix either way, one suffix, one close name).

    A name is looked up once for all labels that ask for it on a day.  Labels that print a given name too are joined
    with the members of that name by what both given names share: nobody's namesakes are listed for each label.
    """
    m = mandates.withColumn("surname_key", resolver_key(F.col("surname"))).withColumn("given_key", resolver_key(F.col("given")))
    p = probes.where("shape IN ('holder', 'given', 'surname') AND key <> ''").withColumn("_q", F.struct("key", "day", "grace", (F.col("shape") == "given").alias("alone")))
    q = p.select("_q").distinct().select("_q", "_q.*")
    by_name = m.select("*", F.inline(_rungs(F.col("surname_key"), (2, _heads(F.col("surname_key"))), (3, _tails(F.col("surname_key"))))))
    asked = q.select("*", F.inline(_rungs(F.col("key"), (2, _heads(F.col("key"))))).alias("lookup", "asked"))
    # The beginning of a label answers to whole surnames only.
    hit = asked.join(by_name, "lookup").where(_valid(F.col("grace")) & ((F.col("asked") == 1) | (F.col("rung") == 1)))
    hit = _lowest(hit.withColumn("rung", F.greatest("rung", "asked")).drop("asked", "lookup"), ("_q",))
    w = Window.partitionBy("_q")
    hit = hit.withColumn("_one", F.min("person_id").over(w) == F.max("person_id").over(w)).where("rung < 3 OR _one").drop("_one")
    left = q.where("NOT alone").join(hit.select("_q").distinct(), "_q", "left_anti")
    near = close_names(left.select("key"), m.select("surname_key"), "key", "surname_key")
    close = left.join(near, "key").join(m, "surname_key").where(_valid(F.col("grace")))
    close = close.withColumn("_names", F.min("surname_key").over(w) == F.max("surname_key").over(w)).where("_names").drop("_names").withColumn("rung", F.lit(4))
    every = hit.unionByName(close).drop("key", "day", "grace", "alone")
    every = cut(every.withColumn("_n", F.count("*").over(w)))
    last = lambda df, *by: df.withColumn("_k", F.row_number().over(Window.partitionBy(*by, "person_id").orderBy(F.desc("load_order")))).where("_k = 1").drop("_k")
    whole = p.where("given_asked IS NULL").join(last(every, "_q"), "_q")
    sole = p.where("given_asked IS NOT NULL").join(every.where("_n = 1"), "_q")
    said = p.select("*", F.explode(_given_asked(F.col("given_asked"))).alias("_by"))
    held = every.where("_n > 1").select("*", F.explode(_given_held(F.col("given_key"))).alias("_by"))
    named = last(said.join(held, ["_q", "_by"]).where(given_matches(F.col("given_asked"), F.col("given_key"))).drop("_by"), *PROBE)
    return whole.unionByName(sole).unionByName(named).drop("_q", "_n")


def settle(candidates: DataFrame, gender: DataFrame | None) -> DataFrame:
    """Marks candidates that masthead or title leave alone (``tiebreak``, ``chosen``), of which there is at most one a label."""
    w = Window.partitionBy(*PROBE)
    long = lambda c: F.filter(_words(F.translate(c, ".", " ")), lambda t: F.length(t) > 2)
    rest = lambda n: F.substr(n, F.lit(1), F.length(n) - F.length("surname_key"))
    presides = F.exists(F.transform("presiding", resolver_key), lambda n: F.endswith(F.concat(F.lit(" "), n), F.concat(F.lit(" "), F.col("surname_key"))) & F.arrays_overlap(long(rest(n)), long(F.col("given_key"))))
    c = candidates.withColumn("_seat", (F.col("shape") == "holder") & F.coalesce(presides, F.lit(False)))
    if gender is None:
        c = c.withColumn("_sex", F.lit(None).cast("boolean"))
    else:
        c = c.withColumn("_first", first_given(F.col("given_key"))).join(gender.select(F.col("given").alias("_first"), F.col("feminine").alias("_sex")), "_first", "left").drop("_first")
    agrees = F.coalesce(F.col("_sex") == honorific_is_feminine(F.col("tidy")), F.lit(False))
    c = c.withColumn("_n", F.count("*").over(w)).withColumn("_seats", F.count_if("_seat").over(w))
    c = c.withColumn("_fits", F.bool_and(F.col("_sex").isNotNull()).over(w) & agrees)
    c = c.withColumn("_titles", F.count_if("_fits").over(w))
    how = F.when(F.col("_n") == 1, "only").when(F.col("_seats") == 1, "masthead").when(F.col("_titles") == 1, "honorific")
    chosen = F.coalesce((how == "only") | ((how == "masthead") & F.col("_seat")) | ((how == "honorific") & F.col("_fits")), F.lit(False))
    return c.withColumn("tiebreak", F.nullif(how, F.lit("only"))).withColumn("chosen", chosen).drop("_seat", "_sex", "_n", "_seats", "_fits", "_titles")


def officer_candidates(probes: DataFrame, officers: DataFrame) -> DataFrame:
    """Officers a label can mean; where the label states an office, of its family only."""
    w = Window.partitionBy(*PROBE)
    keyed = officers.select("*", F.explode("keys").alias("lookup"))
    p = probes.where("shape IN ('holder', 'surname') AND key <> ''")
    asked = p.select("*", F.inline(_rungs(F.col("key"), (2, _heads(F.col("key"))))))
    hit = _lowest(asked.join(keyed, "lookup").where(_valid(F.lit(0)))).drop("lookup")
    left = p.join(hit.select(*PROBE).distinct(), PROBE, "left_anti")
    near = close_names(left.select("key"), keyed.select("lookup"), "key", "lookup")
    close = left.join(near, "key").join(keyed, "lookup").where(_valid(F.lit(0)))
    close = close.withColumn("_names", F.size(F.collect_set("lookup").over(w))).where("_names = 1").withColumn("rung", F.lit(3)).drop("_names", "lookup")
    got = hit.unionByName(close).dropDuplicates([*PROBE, "person_id", "load_order"]).withColumn("family", L.role_family(F.col("role_stem")))
    got = got.where("shape <> 'holder' OR family = asked_family")
    known = F.collect_list(F.when(F.col("curated"), F.struct("family", "keys"))).over(w)
    shadowed = F.exists(known, lambda k: (k["family"] == F.col("family")) & F.arrays_overlap(k["keys"], F.col("keys")))
    got = got.withColumn("_shadowed", shadowed & ~F.col("curated")).where("NOT _shadowed").drop("_shadowed")
    return got.withColumn("n", F.count("*").over(w)).withColumn("place", F.row_number().over(w.orderBy(F.desc("curated"), "load_order")))


def chairs_held(holders: DataFrame, mandates: DataFrame) -> DataFrame:
    """Holders of the chair who sit as members that day: by the longest surname within the officer's name."""
    w = Window.partitionBy(*PROBE)
    named = holders.where("role rlike '(?i)presid'").select(*PROBE, F.explode(F.array_distinct(_phrases(resolver_key(F.col("name"))))).alias("_phrase"))
    fits = named.join(mandates.withColumn("_phrase", resolver_key(F.col("surname"))), "_phrase").where(_valid(F.lit(0)))
    fits = fits.withColumn("_long", F.max(F.length("_phrase")).over(w)).where("length(_phrase) = _long")
    one = fits.groupBy(*PROBE).agg(F.countDistinct("person_id").alias("_n"), F.max_by(F.struct("person_id", "surname", "given", "party", "province"), "load_order").alias("seat"))
    return one.where("_n = 1").drop("_n")


def office_candidates(probes: DataFrame, officers: DataFrame) -> DataFrame:
    """Holders of an office named alone: the same office before its family, terms that open that day before others."""
    w = Window.partitionBy(*PROBE)
    p = probes.where("shape = 'office'").where(~F.col("stem").isin(L.SHARED))
    got = p.join(officers.withColumn("asked_family", L.role_family(F.col("role_stem"))), "asked_family").where(_valid(F.col("grace")))
    for better in (F.col("role_stem") == F.col("stem"), F.coalesce(F.col("begin") == F.col("day"), F.lit(False))):
        got = got.withColumn("_b", better).withColumn("_any", F.bool_or("_b").over(w)).where("_b OR NOT _any").drop("_b", "_any")
    return got.withColumn("n", F.count("*").over(w))


def namesakes(probes: DataFrame, officers: DataFrame) -> DataFrame:
    """Officers whose last word is the surname: of the executive, but for joint sittings, where any."""
    w = Window.partitionBy(*PROBE)
    got = probes.where("shape = 'surname'").join(officers.withColumn("key", F.element_at(_words(resolver_key(F.col("name"))), -1)), "key").where(_valid(F.lit(0)))
    got = got.where((F.coalesce("session_type", F.lit("")) == "ASAMBLEA") | F.col("category").contains("executive"))
    return got.withColumn("n", F.count("*").over(w)).where("n = 1")


def resolve(labels: DataFrame, mandates: DataFrame, officers: DataFrame, gender: DataFrame | None = None) -> DataFrame:
    """label, day, session, label_clean, n, match_status, person_id, person_name, role, party, province, tiebreak.

    One row per (label, day, session); n is the number of its rows.

    A null label or one without a name is unmatched; without candidates a label stays
    unmatched, with several ambiguous; nothing is decided by order but where one holder of an
    office must be taken.
    """
    kinds = labels.select("label").distinct().withColumn("p", L.read(F.col("label")))
    kinds = kinds.select("label", "p.tidy", "p.shape", "p.key", F.col("p.given").alias("given_asked"), "p.role", "p.grace", "p.stem")
    kinds = kinds.withColumn("asked_family", L.role_family(F.col("stem")))
    rows = labels.withColumn("session", F.coalesce("session", F.lit(""))).groupBy(*PROBE)
    rows = rows.agg(F.max("session_type").alias("session_type"), F.max_by("presiding", F.size("presiding")).alias("presiding"), F.count("*").alias("n"))
    probes = rows.join(kinds, rows["label"].eqNullSafe(kinds["label"])).drop(kinds["label"])
    probes = cut(probes)

    seats = settle(cut(member_candidates(probes, mandates)), gender)
    seat = seats.groupBy(*PROBE).agg(F.max(F.when(F.col("chosen"), F.struct("person_id", "surname", "given", "party", "province", "tiebreak"))).alias("m"), F.count("*").alias("n_m"))
    held = cut(officer_candidates(probes, officers))
    top = held.where("place = 1").select(*PROBE, F.struct("person_id", "name", "role_stem").alias("o"), F.col("n").alias("n_o"))
    chair = chairs_held(held.where("place = 1 AND shape = 'holder'"), mandates)
    sole = office_candidates(probes, officers).groupBy(*PROBE).agg(F.count("*").alias("n_s"), F.min(F.struct("load_order", "person_id", "name")).alias("s"))
    alike = namesakes(probes, officers).select(*PROBE, F.struct("person_id", "name", "role_stem").alias("e"))
    gone = _gone(probes, mandates, officers).withColumn("left_office", F.lit(True))

    all_ = probes
    for part in (seat, top, chair, sole, alike, gone):
        all_ = all_.join(part, PROBE, "left")
    c, is_ = F.col, lambda s: F.col("shape") == s
    has = lambda n: F.col(n).isNotNull()
    one_officer = is_("surname") & ~has("n_m") & (F.coalesce("n_o", F.lit(0)) == 1)
    namesake = is_("surname") & ~has("n_m") & ~has("n_o") & has("e")
    trial = F.upper(F.translate(F.coalesce("session_type", F.lit("")), "ÍÓíó", "IOio")).contains("JUICIO POLITICO")
    status = (
        F.when(is_("collective"), "collective")
        .when(is_("elsewhere") | is_("deputy"), "out_of_scope")
        .when(is_("holder") & has("o") & has("seat"), "matched_senator_chair")
        .when(is_("holder") & has("o"), "matched_authority")
        .when(is_("holder") & has("m"), "matched_senator_chair")
        .when(is_("holder") & ~has("n_m") & has("left_office"), "office_only")
        .when(is_("office") & c("stem").isin(L.SHARED), "office_only")
        .when(is_("office") & (c("n_s") == 1), "matched_authority")
        .when(is_("office") & (c("n_s") > 1), "ambiguous")
        .when((is_("given") | is_("surname")) & has("m"), "matched_senator")
        .when(one_officer | namesake, "matched_authority")
        .when(is_("surname") & ~has("n_m") & trial, "out_of_scope")
        .when(has("n_m"), "ambiguous")
        .otherwise("unmatched")
    )
    none = F.lit(None).cast("struct<person_id:string,surname:string,given:string,party:string,province:string>")
    member = F.when(is_("holder") & has("o"), c("seat")).when(has("m"), c("m").dropFields("tiebreak")).otherwise(none)
    officer = F.when(is_("holder") | one_officer, c("o")).when(namesake, c("e")).when(is_("office") & (c("n_s") == 1), F.struct("s.person_id", "s.name", F.col("stem").alias("role_stem")))
    is_member, is_officer = status.startswith("matched_senator"), status == "matched_authority"
    return all_.select(
        *PROBE,
        F.col("tidy").alias("label_clean"),
        "n",
        status.alias("match_status"),
        F.when(is_member, member["person_id"]).when(is_officer, officer["person_id"]).alias("person_id"),
        F.when(is_member, F.concat_ws(", ", member["surname"], member["given"])).when(is_officer, officer["name"]).alias("person_name"),
        F.when(is_("surname") & is_officer, officer["role_stem"]).when(is_("surname") & (status == "out_of_scope"), "parte del juicio político").otherwise(c("role")).alias("role"),
        F.when(is_member, member["party"]).alias("party"),
        F.when(is_member, member["province"]).alias("province"),
        F.when(is_member & ~(is_("holder") & has("o")), c("m.tiebreak")).alias("tiebreak"),
    )


def titles_learned(resolved: DataFrame, least: int = 4, share: float = 0.8) -> DataFrame:
    """given, feminine: first given names whose titles agree, by the passages of members that ``resolved`` names."""
    named = resolved.where("match_status IN ('matched_senator', 'matched_senator_chair')")
    given = first_given(resolver_key(F.regexp_extract("person_name", ",(.*)$", 1)))
    pairs = named.select(given.alias("given"), honorific_is_feminine(F.col("label_clean")).alias("feminine"), "n").where("given IS NOT NULL")
    return learned_flags(pairs, "given", "feminine", "n", least, share).select("given", "feminine")


def resolve_twice(labels: DataFrame, mandates: DataFrame, officers: DataFrame, least: int = 4, share: float = 0.8) -> DataFrame:
    """``resolve``, then once more for what stayed ambiguous, with the titles that the first pass has taught.

    Names count as learned from ``least`` passages on of which ``share`` agree. Nothing decided by a title is learned from.
    """
    first = cut(resolve(labels, mandates, officers))
    open_ = first.where("match_status = 'ambiguous'").select(*PROBE)
    rest = labels.withColumn("session", F.coalesce("session", F.lit(""))).join(open_, PROBE, "left_semi")
    again = resolve(rest, mandates, officers, cut(titles_learned(first, least, share)))
    return first.where("match_status <> 'ambiguous'").unionByName(again)


def _gone(probes: DataFrame, mandates: DataFrame, officers: DataFrame) -> DataFrame:
    """Holders' names that someone bore in a seat or an office before the day, and nobody bears on it."""
    terms = mandates.select(resolver_key(F.col("surname")).alias("key"), "begin", "end").union(officers.select(F.explode("keys"), "begin", "end"))
    got = probes.where("shape = 'holder'").select(*PROBE, "key").join(terms, "key").groupBy(*PROBE)
    sums = got.agg(F.bool_or(F.coalesce(F.col("end") < F.col("day"), F.lit(False))).alias("_past"), F.bool_or(in_window(F.col("begin"), F.col("end"), F.col("day"))).alias("_now"))
    return sums.where("_past AND NOT _now").select(*PROBE)
