"""Semantic rules on hand-made rows, and brute-force properties."""

import datetime as dt
import random

from pyspark.sql import functions as F

from turnstone.functions import taxonomy, text
from turnstone.operators import linkage, matching, relational, segmentation, temporal
from turnstone.operators.containment import rebuilt_from


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_word_count(spark):
    df = spark.createDataFrame([(None,), ("",), (" a  b ",), (" a b",)], "t string")
    assert [r[0] for r in df.select(text.word_count(F.col("t"))).collect()] == [None, 0, 2, 2]


def test_native_folds_match_exact_ones(spark):
    df = spark.createDataFrame([("Straße  ÑANDÚ é!",), ("",), (None,), ("Ÿ Çà 12",)], "t string")
    got = df.select(text.resolver_key(F.col("t")).alias("a"), text.exact_resolver_key("t").alias("b"), text.letters_and_digits(F.col("t")).alias("c"), text.exact_letters_and_digits("t").alias("d")).collect()
    assert all(r["c"] == r["d"] for r in got[:3]) and got[0]["a"] == got[0]["b"] == "strasse nandu e!"


def test_first_match_wins(spark):
    df = spark.createDataFrame([("a las 15 se vota",), (None,)], "t string")
    rules = [("timestamp", "a las [0-9]"), ("vote", "vota")]
    assert [r[0] for r in df.select(taxonomy.first_match(F.col("t"), rules, "unspecified")).collect()] == ["timestamp", "unspecified"]


def test_asof_ties_and_edges(spark):
    left = spark.createDataFrame([(1, "p", day(300)), (2, "q", day(300)), (3, "r", day(300))], "probe long, who string, day date")
    right = spark.createDataFrame([("p", day(290), "A"), ("p", day(310), "B"), ("q", day(100), "C"), ("r", day(99), "D")], "who string, seen date, value string")
    got = {r["probe"]: (r["value"], r["gap"]) for r in temporal.asof_nearest(left, right, "who", "day", "seen", "value", 200).collect()}
    assert got == {1: ("A", 10), 2: ("C", 200), 3: (None, None)}


def test_asof_against_brute_force(spark):
    draw = random.Random(1)
    left = [(k, draw.choice("xyz"), day(draw.randrange(60))) for k in range(60)]
    right = list({(draw.choice("xyz"), day(draw.randrange(60)), draw.choice("AB")) for _ in range(40)})
    want = {}
    for k, who, d in left:
        near = sorted((abs((s - d).days), s, v) for w, s, v in right if w == who and abs((s - d).days) <= 5)
        want[k] = near[0] if near else (None, None, None)
    a, b = spark.createDataFrame(left, "probe long, who string, day date"), spark.createDataFrame(right, "who string, seen date, value string")
    assert {r["probe"]: (r["gap"], r["seen"], r["value"]) for r in temporal.asof_nearest(a, b, "who", "day", "seen", "value", 5).collect()} == want


def test_spells_end_at_blanks(spark):
    rows = [("s", 1, "X"), ("s", 2, "X"), ("s", 3, None), ("s", 4, "X"), ("s", 5, "Y")]
    df = spark.createDataFrame(rows, "who string, at int, v string")
    got = {(r["v"], r["begin"], r["end"]) for r in temporal.spells(df, "who", ["at"], "v", "at").collect()}
    assert got == {("X", 1, 2), ("X", 4, 4), ("Y", 5, 5)}


def test_clip_gives_the_rest_to_the_predecessor(spark):
    spells = spark.createDataFrame([("s", "X", day(1), day(10)), ("s", "Z", day(1), day(2))], "who string, v string, begin date, end date")
    lives = spark.createDataFrame([("X", day(4), day(8), "P")], "v string, life_begin date, life_end date, predecessor string")
    got = {(r["v"], r["begin"], r["end"]) for r in temporal.clipped(spells, lives, "v").collect()}
    assert got == {("X", day(4), day(8)), ("P", day(1), day(4)), ("Z", day(1), day(2))}


def test_multiset(spark):
    a, b = (spark.createDataFrame([(c,) for c in s], "k string") for s in ("aab", "abb"))
    assert relational.multiset_overlap(a, b, ["k"]).first()["overlap"] == 2


def test_matching_beats_first_fit():
    gold, found = [("l", "p a"), ("l", "p b")], [("l", "p"), ("l", "p a x")]
    assert matching.largest_matching(gold, found) == 2 and matching.first_fit(gold, found) == 1


def test_rebuilt_in_order():
    assert rebuilt_from("abcxyz", "__abc__xyz__") and not rebuilt_from("xyzabc", "__abc__xyz__")
    assert not rebuilt_from("abcdefghi", "a-b-c-d-e-f-g-h-i") and rebuilt_from("abcdefgh", "a-b-c-d-e-f-g-h-i")


def test_turns(spark):
    rows = [(1, 1, "note"), (1, 2, "label"), (1, 3, "text"), (1, 4, "heading"), (1, 5, "text"), (1, 6, "label")]
    df = spark.createDataFrame(rows, "doc int, seq int, kind string")
    got = segmentation.turns(df, "doc", ["seq"], F.col("kind") == "label", F.col("kind") == "heading").orderBy("seq").collect()
    assert [r["turn_id"] for r in got] == [None, 1, 1, None, None, 2]


def test_consolidated_keeps_order(spark):
    rows = [(1, k, w, t) for k, w, t in ((1, "A", "a"), (2, "A", "b"), (3, "B", "c"), (4, "A", "d"))]
    df = spark.createDataFrame(rows, "doc int, seq int, who string, text string")
    got = segmentation.consolidated(df, "doc", "seq", ["who"], "text").orderBy("seq").collect()
    assert [(r["who"], r["text"]) for r in got] == [("A", "a b"), ("B", "c"), ("A", "d")]


def test_cascade_rungs(spark):
    targets = spark.createDataFrame([(1, "ana diaz"), (2, "juan lopez"), (3, "eva ruiz")], "id int, name string")
    probes = spark.createDataFrame([(1, "ana diaz"), (2, "juan"), (3, "ruiz"), (4, "nobody")], "probe int, key string")
    got = {r["probe"]: (r["id"], r["rung"]) for r in linkage.cascade_match(probes, targets, "probe", "key", "id", "name").collect()}
    assert got == {1: (1, "exact"), 2: (2, "prefix"), 3: (3, "suffix")}


def test_upsert_new_wins(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c", 1), (3, "d", 1)], "k int, v string, x int")
    assert sorted(map(tuple, relational.upsert(old, new, ["k"]).collect())) == [(1, "a", None), (2, "c", 1), (3, "d", 1)]
