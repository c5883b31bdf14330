"""Queries of the passes against their SQL, and the operators that SQL does not cover against plain Python."""

import glob
import os

import duckdb
import pytest

from turnstone.plans import passes as plans
from turnstone.plans.catalog import ORACLES, QUERIES

from .conftest import SF

OWN = [n for n, f in QUERIES.items() if f.__module__ == plans.__name__]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", [n for n in OWN if n in ORACLES])
def test_against_sql(spark, con, name):
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(got.columns)
    shown = lambda v: round(float(v), 6) if isinstance(v, float) else v
    assert sorted((tuple(map(shown, r)) for r in got.select(columns).collect()), key=repr) == sorted((tuple(map(shown, r)) for r in want.fetchall()), key=repr)


def test_running_header():
    from turnstone.operators.placement import running_header

    pages = ["senadodelanacionreunionalgo", "senadodelanacionreunionotro", "senadodelanacionreunionmas", "x", ""]
    assert running_header(pages) == "senadodelanacionreunion"
    assert running_header(pages[:2] + ["x", "y"]) is None and running_header([]) is None
    # Three of eleven pages are under three tenths of them.
    assert running_header(pages[:3] + [f"otherstripofpage{k:0>3}"[::-1] for k in range(8)]) is None


def test_places_and_occurrences(spark):
    from turnstone.operators.placement import placed, places, starts

    assert starts("asi.si.no", "si.") == [4]
    assert starts("¡si!noesasi!si!", "si!") == [1, 12]
    assert places("abcabcabd", ["abc", "abc", "abd", "zz", ""]) == [0, 3, 6, None, None]
    text = spark.createDataFrame([(1, 0, "Tiene la palabra."), (1, 1, "Gracias."), (1, 2, "Tiene la palabra."), (1, 3, "nowhere")], "doc long, seq long, text string")
    source = spark.createDataFrame([(1, "Tiene la palabra. Gracias. Tiene la palabra.")], "doc long, source string")
    got = {r["seq"]: (r["occurrence"], r["occurrences"]) for r in placed(text, source, "doc", "seq", "text", "source").collect()}
    assert got == {0: (1, 2), 1: (1, 1), 2: (2, 2), 3: (None, 0)}


def test_chapters(spark):
    from pyspark.sql import functions as F

    from turnstone.operators.passes import chapters

    rows = [(0, "text"), (1, "2 Opening"), (2, "522 Works"), (3, "4 Next"), (4, "9. Jump"), (5, "3 Back"), (6, "10 On")]
    got = chapters(spark.createDataFrame([(1, k, t) for k, t in rows], "doc int, seq int, text string"), "doc", "seq", "text", F.col("text").rlike("^[0-9]"))
    assert [r["chapter"] for r in got.orderBy("seq").collect()] == [None, 2, 2, 4, 9, 9, 10]


def test_small_passes(spark):
    from pyspark.sql import functions as F

    from turnstone.operators import passes

    def texts(df):
        return [r["text"] for r in df.orderBy("seq", *[c for c in df.columns if c == "part"]).collect()]

    make = lambda rows, cols: spark.createDataFrame([(1, k, *r) for k, r in enumerate(rows)], f"doc int, seq int, {cols}")
    assert texts(passes.split_words_joined(make([("T", "normal", 14.0), ("iene la palabra", "normal", 12.0), ("Nota.", "normal", 9.0), ("abc", "normal", 12.0)], "text string, style string, size double"), "doc", "seq", "text", "style", "size", 12.0)) == ["Tiene la palabra", "Nota.", "abc"]
    assert texts(passes.welded_notes_split(make([("— Se vota. — Es afirmativa.", "event", "x"), ("a. — B", "speech", "y")], "text string, kind string, who string"), "text", "kind", ["who"])) == ["— Se vota.", "— Es afirmativa.", "a. — B"]
    assert texts(passes.dashes_returned(make([("Gracias. —", None), ("Se vota.", "event"), ("a —", None), ("— b", "event")], "text string, kind string"), "doc", "seq", "text", "kind")) == ["Gracias. ", "— Se vota.", "a —", "— b"]
    assert texts(passes.fused_labels_split(make([("Obras en Chubut Sr. Quiroz", "bold"), ("Sr. Quiroz", "bold"), ("a Sr. B", "normal")], "text string, style string"), "text", "style")) == ["Obras en Chubut", "Sr. Quiroz", "Sr. Quiroz", "a Sr. B"]
    assert texts(passes.first_speech_cleaned(make([(". — Pido", 1, "speech"), (". — Más", 1, "speech"), ("- Note", 1, "event")], "text string, turn int, kind string"), "doc", "seq", "turn", "text", "kind")) == ["Pido", ". — Más", "- Note"]
    assert texts(passes.without_empty(make([("(cid:47) ",), ("(cid:47) a",), (" ",)], "text string"), "text")) == ["(cid:47) a"]
    dates = make([("– En Buenos Aires, a las 15 y 33 del miércoles 28 de abril de 2010:", "2010-04-29")], "text string, own string").withColumn("own", F.to_date("own"))
    assert [(str(r["said"]), r["days_off"]) for r in passes.opening_dates(dates, "doc", "seq", "text", "own").collect()] == [("2010-04-28", -1)]
    debate = make([("a", 1, "speech"), ("BEGIN", 2, "speech"), ("note", None, "event"), ("END", 3, "speech"), ("b", 4, "speech")], "text string, turn int, kind string")
    got = passes.inserted_debate_unattributed(debate, "doc", "seq", "turn", "kind", F.col("text") == "BEGIN", F.col("text") == "END").orderBy("seq").collect()
    assert [(r["kind"], r["turn"]) for r in got] == [("speech", 1), ("other", None), ("other", None), ("other", None), ("speech", 2)]
    page = make([(1.0, 2.0, 1.0, 2.0), (11.0, 12.0, 1.0, 2.0)], "x0 double, x1 double, top double, bottom double").withColumn("on", passes.on_page(F.col("x0"), F.col("x1"), F.col("top"), F.col("bottom"), F.lit(0), F.lit(0), F.lit(10), F.lit(10)))
    assert [r["on"] for r in page.orderBy("seq").collect()] == [True, False]


def test_people_and_counts(spark):
    from turnstone.operators.caucus import canonical_caucus, deduced_from_counts, person_of

    roster = spark.sql("SELECT person, surname, given, CAST(since AS DATE) since, CAST(until AS DATE) until FROM VALUES (1, 'DUARTE LÓPEZ', 'Ana', '1995-01-01', '1999-01-01'), (2, 'DUARTE', 'Juan', '1990-01-01', '1994-01-01'), (3, 'Quiroz', 'Eva', '1995-01-01', NULL), (4, 'Eva', 'Quiroz Mena', '1980-01-01', '1981-01-01') AS t(person, surname, given, since, until)")
    seen = spark.sql("SELECT printed, CAST(day AS DATE) day FROM VALUES ('Duarte-Lopez, Ana', '1996-01-01'), ('Duarte, Juan', '1996-01-01'), ('Duarte, Pedro', '1996-01-01'), ('QUIROZ, EVA', '1996-01-01') AS t(printed, day)")
    got = {r["printed"]: (r["person"], r["how"]) for r in person_of(seen, roster).collect()}
    assert got == {"Duarte-Lopez, Ana": (1, "surname and given name, in office"), "Duarte, Juan": (2, "exact name, any date"), "Duarte, Pedro": (None, None), "QUIROZ, EVA": (3, "exact name, in office")}
    pages = spark.sql("SELECT printed, CAST('1996-01-01' AS DATE) day FROM VALUES ('EVA QUIROZ'), ('ANA DUARTE LOPEZ') AS t(printed)")
    assert {r["printed"]: r["person"] for r in person_of(pages, roster, True).collect()} == {"EVA QUIROZ": 3, "ANA DUARTE LOPEZ": 1}
    names = spark.createDataFrame([("Bloque Unión-Cívica.",), ("UNION CIVICA",)], "c string")
    from pyspark.sql import functions as F

    assert len({r[0].strip() for r in names.select(canonical_caucus(F.col("c"))).collect()}) == 1
    official = spark.createDataFrame([(1, "A", 2), (1, "B", 2)], "day int, caucus string, n int")
    known = spark.createDataFrame([(1, 10, "A"), (1, 11, "A"), (1, 12, "B")], "day int, person int, caucus string")
    serving = spark.createDataFrame([(1, p) for p in (10, 11, 12, 13)], "day int, person int")
    assert [tuple(r) for r in deduced_from_counts(official, known, serving).collect()] == [(1, 13, "B")]
    assert deduced_from_counts(official, known, serving.union(spark.createDataFrame([(1, 14)], "day int, person int"))).count() == 0


def test_boxes_are_added_in_order(spark, tmp_path):
    from turnstone.operators.passes import scanned_pages

    rows = [(page, k, w, 1.0, 1.0) for page, own in ((1, (0.1, 0.2, 0.3)), (2, (0.3, 0.2, 0.1)), (None, (0.1, 0.2, 0.3)), (3, (0.5, -9.0, 0.5)), (4, (0.0, 0.0, 0.1))) for k, w in enumerate(own)]
    images = spark.createDataFrame(rows[::-1] + [(5, 0, 0.1, 1.0, None)], "page int, k int, w double, h double, area double").repartition(3)
    assert {r["page"]: r["scanned"] for r in scanned_pages(images, ["page"], "w", "h", "area", order=["k"]).collect()} == {1: True, 2: False, None: True, 3: True, 4: False, 5: None}
    # Six boxes of 0.05, three in each of two files: added one by one they are no more than 0.3.
    line = [(7, 0.05 + 0.05, 1.0, 0.05)] * 3
    for k in range(2):
        spark.createDataFrame(line, "l_orderkey long, l_discount double, l_quantity double, l_tax double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/lineitem.parquet")
    one = duckdb.connect(config={"threads": 1})
    one.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    assert [tuple(r) for r in QUERIES["scanned_pages"](spark, str(tmp_path)).collect()] == one.execute(ORACLES["scanned_pages"]).fetchall() == [(7, False)]


def test_readings_of_one_day_are_told_apart(spark):
    import datetime as dt

    from turnstone.operators.caucus import caucus_on

    day = lambda n: dt.date(2020, 1, n) if n else None
    days = spark.createDataFrame([(1, day(20))], "person int, day date")
    lives = spark.createDataFrame([], "caucus string, since date, until date")
    terms = spark.createDataFrame([(1, day(1), None)], "person int, since date, until date")
    rows = [(1, day(10), "A", "confirmed", "page"), (1, day(10), "A", "unchecked", "page"), (1, day(10), None, "confirmed", "page"), (1, None, "B", "confirmed", "page")]
    for own in (rows, rows[::-1]):
        readings = spark.createDataFrame(own, "person int, date date, caucus string, status string, basis string").coalesce(1)
        got = caucus_on(days, readings, lives, terms).first()
        assert (got["caucus"], got["status"], got["observed"], got["gap"]) == ("A", "confirmed", day(10), 10)


def test_audit_finds_foreign_text(spark):
    from turnstone.operators.placement import audited

    source = "la presidencia informa que se va a votar el proyecto de ley sobre las obras publicas en el norte del pais y sus plazos"
    rows = [(1, source[:90]), (1, "otra cosa que nadie dijo nunca en esta sesion y que no figura en ninguna parte del documento"), (1, "corto")]
    got = audited(spark.createDataFrame(rows, "doc int, text string"), spark.createDataFrame([(1, source)], "doc int, source string"), "doc", "text", "source").first()
    assert (got["probed"], got["located"], got["foreign_share"]) == (2, 1, 0.5)
