"""Deltas of terminal bonds, and tables of goodness-of-fit tests."""

from ionloom.operators import ptm
from ionloom.sources import tables


def test_bond_delta_is_the_first_static_one(spark):
    rows = [("", 9.0, "Variable", "Bond_N"), ("", 42.0, "Static", "Bond_N"), ("", 1.0, "Static", "Bond_N"), ("C", 57.0, "Static", "Anywhere")]
    ptms = spark.createDataFrame(rows, ptm.PTM_SCHEMA).coalesce(1)
    got = ptms.agg(ptm.bond_delta(ptms, "Bond_N").alias("n"), ptm.bond_delta(ptms, "Bond_C").alias("c")).first()
    assert (got.n, got.c) == (42.0, 0.0)
    none = ptms.limit(0)
    assert none.agg(ptm.bond_delta(none, "Bond_N").alias("n")).first().n == 0.0


def test_goodness_tables(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("test_name\tdistribution\tstatistic\tp_value\nks\tgumbel\t0.25\t0.5\nks\tnormal\t\t1e-9\n")
    got = tables.read_goodness(spark, str(tmp_path / "a.tsv")).collect()
    assert [tuple(r) for r in got] == [("ks", "gumbel", 0.25, 0.5), ("ks", "normal", None, 1e-9)]
