"""Documents that hold every awkward case, with columns whose names clash with results."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, block long, fp long, _q_row string, kept string"
LONG = " ".join(f"w{k * 7919 % 4001}" for k in range(9000))
PASSAGE = " ".join(f"passage{k}" for k in range(30))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs into the forest of old trees"),
    (2, "The quick brown fox jumps over the lazy dog and runs into the forest of old trees"),
    (3, "the quick brown fox jumps over the lazy dog and runs into the forest of old trees"),
    (4, None),
    (5, ""),
    (6, "  \n\t "),
    (7, LONG),
    (7, LONG),
    (8, f"before it {PASSAGE} after it"),
    (9, f"{PASSAGE} {PASSAGE}"),
    (10, "a a a a a a a a a a a a a a a a a a a a a a a a a a a"),
    (11, "b a a a a a a a a a a a a a a a a a a a a a a a c"),
    (12, "one\nline\none\nline\n\n日本語 ß é <|endoftext|> ▁x  y   z   \x85 ²"),
    (None, "no id but words enough to be a text of its own kind here"),
    (13, "12 34 !!"),
    (14, "x"),
    (15, "Der schnelle braune Fuchs springt über den faulen Hund und läuft in den Wald"),
    (16, "12 34 !!"),
]


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "en" if i and i % 2 else "de", f"s{(i or 0) % 3}", len(t or ""), 1, 2, 3, "x", "y") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
