"""Records against what is found now."""

from pyspark.sql import functions as F

from turnstone.operators import verification as v


def test_search_key_and_windows(spark):
    long = "abcdefghijklmnopqrstuvwxyz0123"
    shown = {"Ab (cid:12) Cdé fg": "cdefg", None: "", "": "", "abcd": "ab", "Nº 3E dijo": "dijo"}
    df = spark.createDataFrame([(k,) for k in shown], "q string")
    assert {r[0]: r[1] for r in df.select("q", v.search_key(F.col("q"))).collect()} == shown
    keys = spark.createDataFrame([(long,), (long[:24],), ("short",)], "k string")
    got = [r[0] for r in keys.select(v.search_windows(F.col("k"))).collect()]
    assert got == [[long[:24], long[3:27], long[6:]], [long[:24]], ["short"]]


def test_verdicts(spark):
    rows = [("Sr. Pinedo", ["SR PINEDO"]), ("Sr. Presidente (Pinedo).- C", ["Sr. Presidente (Pinedo)"]), ("Sr. Martí", ["Sr. Martinazzo"]), ("Sr. A", ["Sr. A", "Sr. B"]), ("Sr. A", []), (None, [None])]
    df = spark.createDataFrame(rows, "recorded string, found array<string>")
    assert [r[0] for r in df.select(v.verdict(F.col("recorded"), F.col("found"))).collect()] == ["holds", "holds", "changed", "several", None, "holds"]
