"""Every registered core query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from ionloom.plans import catalog

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, db, name):
    df = catalog.QUERIES[name](spark, DIR)
    want = db.execute(catalog.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, want.fetchall())


def test_decoys_keep_their_rules(spark):
    for r in catalog.QUERIES["decoy_udtf"](spark, DIR).collect():
        assert abs(r.mass - r.mass_int) <= r.mass_int * catalog.PPM // 1_000_000
        assert 6 <= len(r.sequence) <= 50


def test_loop_scores_are_probabilities(spark):
    got = [r.loop_score for r in catalog.QUERIES["loop_score"](spark, DIR).collect()]
    assert len(got) == 500 and all(0 <= x <= 1 for x in got)


def test_entry_has_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
