"""The driver's contract; most queries are held against SQL by DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

from .conftest import SF

SOME = ["sum_pivot_by_year", "exact_quantiles", "asof_nearest", "spells_clipped", "cascade_match", "probe_containment", "multiset_overlap", "resolve_labels", "resolve_twice", "read_verdicts"]


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", SOME)
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got = entry.queries()[name](spark, SF)
    want = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    shown = lambda v: round(v, 6) if isinstance(v, float) else v
    assert sorted((tuple(map(shown, r)) for r in got.select(columns).collect()), key=repr) == sorted((tuple(map(shown, r)) for r in want.fetchall()), key=repr)
