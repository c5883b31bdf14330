"""Labels resolved to people, on hand-made rosters."""

import datetime as dt

from pyspark.sql import functions as F

from turnstone.functions import labels
from turnstone.operators import resolution

D = dt.date(2010, 5, 1)
OPEN, SHUT = dt.date(2005, 1, 1), dt.date(2015, 1, 1)
MEMBERS = [
    ("m1", "Arrieta", "Mario", "U", "Misiones", OPEN, SHUT, 1),
    ("m2", "Robles", "Gladys", "P", "Chaco", OPEN, SHUT, 2),
    ("m3", "Robles", "Pedro", "J", "Salta", OPEN, SHUT, 3),
    ("m4", "Quinn Alvarado", "Luis", "U", "Formosa", OPEN, SHUT, 4),
    ("m5", "Duarte Ocampo de Vera", "Claudia", "F", "Santiago", OPEN, SHUT, 5),
    ("m6", "Bermejo", "Juan", "J", "Córdoba", dt.date(1999, 1, 1), dt.date(2002, 12, 27), 6),
    ("m7", "Zelaya", "Ana", "J", "Jujuy", dt.date(2010, 12, 1), None, 7),
]
OFFICERS = [
    ("auth:1", "Mario Arrieta", ["arrieta"], "presidencia provisional", "chamber", OPEN, SHUT, True, 1),
    ("auth:2", "Juan Tapia", ["tapia"], "secretaria", "chamber", OPEN, SHUT, True, 2),
    ("seen:2", "J. Tapia", ["tapia", "juan tapia"], "secretaria", "cover", OPEN, SHUT, False, 3),
    ("auth:4", "Clara Ibarra", ["montes"], "presidencia de la nacion", "executive", OPEN, SHUT, True, 4),
]
MEMBER = "person_id string, surname string, given string, party string, province string, begin date, end date, load_order long"
OFFICER = "person_id string, name string, keys array<string>, role_stem string, category string, begin date, end date, curated boolean, load_order long"
ASKED = "label string, day date, session string, session_type string, presiding array<string>"


def test_read(spark):
    shown = {
        "Sr.3 Presidente (Arrieta)": ("Sr. Presidente (Arrieta)", "holder", "arrieta"),
        "S. Presidente (Arrieta)": ("Sr. Presidente (Arrieta)", "holder", "arrieta"),
        "DEL VALLE": ("Sr. DEL VALLE", "surname", "del valle"),
        "risas Sr. Robles.- ¡Sí": ("Sr. Robles", "surname", "robles"),
        "risasSr. Robles": ("Sr. Robles", "surname", "robles"),
        "Sra.Presidenta": ("Sra. Presidenta", "office", None),
        "Sr- Robles": ("Sr. Robles", "surname", "robles"),
        "SR. PRESIDENTE ((Arrieta)": ("Sr. PRESIDENTE (Arrieta)", "holder", "arrieta"),
        "Sr. PRESIDENTE Arrieta)": ("Sr. PRESIDENTE (Arrieta)", "holder", "arrieta"),
        "Sr. Presidente)": ("Sr. Presidente", "office", None),
        "Sr. Presidente (Arrieta": ("Sr. Presidente (Arrieta)", "holder", "arrieta"),
        "Sr. Presidente (Arrieta) (Arrieta).": ("Sr. Presidente (Arrieta)", "holder", "arrieta"),
        "Sr. Presidente (Arrieta) (Robles)": ("Sr. Presidente (Arrieta) (Robles)", "surname", "presidente (arrieta) (robles)"),
        "Sr. Presdiente (Robles)": ("Sr. Presidente (Robles)", "holder", "robles"),
        "Sra. Unzue\u0301, Ana": ("Sra. Unzué, Ana", "surname", "unzue"),
        "Sr. (Robles)": ("Sr. (Robles)", "given", ""),
        "un señor senador.-": ("un señor senador", "collective", None),
        "Presidente de la República del Sur": ("Sr. Presidente de la República del Sur", "elsewhere", None),
        "Sr.": ("Sr", "none", None),
        "": ("", "none", None),
        None: (None, "none", None),
    }
    df = spark.createDataFrame([(k,) for k in shown], "label string").withColumn("p", labels.read(F.col("label")))
    assert {r[0]: tuple(r[1:]) for r in df.select("label", "p.tidy", "p.shape", "p.key").collect()} == shown


def test_stem_and_family(spark):
    shown = {
        "Vicepresidenta del H. Senado": ("vicepresidencia", "chair"),
        "Presidenta de la Nación": ("presidencia de la nacion", "national_presidency"),
        "Jefe de Gabinete de Ministros": ("jefatura de gabinete", "cabinet"),
        "Prosecretario": ("prosecretaria", "secretariat"),
    }
    df = spark.createDataFrame([(k,) for k in shown], "role string").withColumn("stem", labels.role_stem(F.col("role")))
    assert {r[0]: (r[1], r[2]) for r in df.select("role", "stem", labels.role_family(F.col("stem"))).collect()} == shown


def test_decision_list(spark):
    want = {
        "Varios señores senadores": ("collective", None),
        "Sr. Ministro de Economía": ("out_of_scope", None),
        "Sr. Presidente (Arrieta)": ("matched_senator_chair", "m1"),
        "Sr. Secretario (Tapia)": ("matched_authority", "auth:2"),
        "Sr. Presidente (Bermejo)": ("office_only", None),
        "Sr. Presidente": ("office_only", None),
        "Sra. Presidenta de la Nación": ("matched_authority", "auth:4"),
        "Sra. Robles (Gladys)": ("matched_senator", "m2"),
        "Sr. Robles (P.)": ("matched_senator", "m3"),
        "Sra. Robles": ("matched_senator", "m2"),
        "Sres. Robles": ("ambiguous", None),
        "Sr. Alvarado": ("matched_senator", "m4"),
        "Sra. Duarte Ocampo": ("matched_senator", "m5"),
        "Sr. Arrrieta": ("matched_senator", "m1"),
        "Sra. Zelaya": ("unmatched", None),
        "Sra. Senadora electa Zelaya": ("matched_senator", "m7"),
        "Sr. Diputado Pérez": ("out_of_scope", None),
        "Sra. Ibarra": ("matched_authority", "auth:4"),
        "Sr. Nadie": ("unmatched", None),
        None: ("unmatched", None),
    }
    asked = spark.createDataFrame([(k, D, None, "ORDINARIA", None) for k in want] * 2, ASKED)
    gender = spark.createDataFrame([("gladys", True), ("pedro", False)], "given string, feminine boolean")
    got = resolution.resolve(asked, spark.createDataFrame(MEMBERS, MEMBER), spark.createDataFrame(OFFICERS, OFFICER), gender).collect()
    assert len(got) == len(want)
    assert {r["label"]: (r["match_status"], r["person_id"]) for r in got} == want
    assert {r["label"]: r["tiebreak"] for r in got if r["tiebreak"]} == {"Sra. Robles": "honorific"}
    assert {r["n"] for r in got} == {2}


def test_sittings_of_a_day_keep_their_chairs(spark):
    chair = "Sr. Presidente (Robles)"
    asked = spark.createDataFrame([(chair, D, "1", "ORDINARIA", ["Gladys Robles"]), (chair, D, "2", "ORDINARIA", ["Pedro Robles"]), (chair, D, "3", "ORDINARIA", None)], ASKED)
    got = resolution.resolve(asked, spark.createDataFrame(MEMBERS, MEMBER), spark.createDataFrame(OFFICERS, OFFICER)).collect()
    assert {r["session"]: (r["match_status"], r["person_id"], r["tiebreak"]) for r in got} == {"1": ("matched_senator_chair", "m2", "masthead"), "2": ("matched_senator_chair", "m3", "masthead"), "3": ("ambiguous", None, None)}


def test_titles_are_learned_from_settled_labels_only(spark):
    said = ["Sra. Robles (Gladys)"] * 4 + ["Sr. Robles (Pedro)"] * 5 + ["Sra. Robles (Pedro)"] + ["Sra. Robles", "Sr. Robles", "Sres. Robles"]
    members, officers = spark.createDataFrame(MEMBERS, MEMBER), spark.createDataFrame(OFFICERS, OFFICER)
    ask = lambda rows: {r["label"]: (r["match_status"], r["person_id"]) for r in resolution.resolve_twice(spark.createDataFrame([(x, D, "1", None, None) for x in rows], ASKED), members, officers).collect()}
    got = ask(said)
    assert (got["Sra. Robles"], got["Sr. Robles"], got["Sres. Robles"]) == (("matched_senator", "m2"), ("matched_senator", "m3"), ("ambiguous", None))
    # Three passages settle no name.
    assert ask(said[1:])["Sra. Robles"] == ("ambiguous", None)


def test_given_names_meet_by_lookup_where_they_match(spark):
    """Given names share a lookup exactly where they match, so that namesakes need not be listed for each label."""
    from itertools import product

    from pyspark.sql import functions as F

    from turnstone.functions.taxonomy import given_matches

    printed, held = ["ana", "a", "a.", "a. b.", "j. m.", "ana b", "maria j", ".", "", "b a", None], ["ana", "ana belen", "belen ana", "juan manuel", "juan  manuel", "j", "maria jose", "", None]
    both = spark.createDataFrame(list(product(printed, held)), "a string, b string")
    got = both.select("a", "b", F.coalesce(given_matches(F.col("a"), F.col("b")), F.lit(False)), F.coalesce(F.arrays_overlap(resolution._given_asked(F.col("a")), resolution._given_held(F.col("b"))), F.lit(False))).collect()
    assert [r for r in got if r[2] != r[3]] == [] and 10 < sum(r[2] for r in got) < 60


def test_namesakes_are_told_apart_by_given_names(spark):
    members = [(f"m{k}", "Robles", f"Giv{k} {'Ana' if k % 2 else 'Luis'}", None, None, D, None, k) for k in range(30)]
    said = [f"Sr. Robles (Giv{k})" for k in range(30)] + ["Sr. Robles (Ana)", "Sr. Robles (G. A.)", "Sr. Robles", "Sr. Robles (Otto)"]
    asked = spark.createDataFrame([(x, D, "1", None, None) for x in said], ASKED)
    got = {r["label"]: (r["match_status"], r["person_id"]) for r in resolution.resolve(asked, spark.createDataFrame(members, MEMBER), spark.createDataFrame(OFFICERS, OFFICER)).collect()}
    assert got == {f"Sr. Robles (Giv{k})": ("matched_senator", f"m{k}") for k in range(30)} | {x: ("ambiguous", None) for x in said[30:33]} | {said[33]: ("unmatched", None)}
