"""Steps whose cost is to grow no faster than their tables."""

import glob
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ionloom.operators import candidates as C
from ionloom.operators import decoys, xcorr
from ionloom.plans import catalog
from tests.test_catalog import DIR, rows

COPIES = 3


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """Tables whose parts and events come ``COPIES`` times under keys of their own, and one event twice under one key."""
    out = str(tmp_path_factory.mktemp("copies"))
    for f in glob.glob(f"{DIR}/*.parquet"):
        os.symlink(f, f"{out}/{os.path.basename(f)}") if os.path.basename(f)[:-8] not in ("part", "events") else None
    for name, key in (("part", "p_partkey"), ("events", "event_id")):
        t = spark.read.parquet(f"{DIR}/{name}.parquet")
        more = t.crossJoin(spark.range(COPIES).withColumnRenamed("id", "copy")).withColumn(key, F.col(key) + 100_000 * F.col("copy")).drop("copy")
        more = more.unionByName(t.where("value between 205 and 260 and user_id % 5 = 2").withColumn("value", F.col("value") + 0.4)) if name == "events" else more
        more.coalesce(1).write.parquet(f"{out}/{name}.parquet")
    return out


@pytest.mark.parametrize("name", ["variable_window_counts", "candidate_limit", "search_space_fasta", "decoy_fillup", "xcorr_score"])
def test_copies_equal_sql(spark, copies, name):
    c = duckdb.connect()
    for f in glob.glob(f"{copies}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f + '/*.parquet' if os.path.isdir(f) else f}'")
    want = c.execute(catalog.ORACLES[name])
    columns = [x[0] for x in want.description]
    df = catalog.QUERIES[name](spark, copies)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, want.fetchall())


def test_decoys_of_one_small_file_use_all_cores(spark):
    m = F.lit(950_000_000).cast("long") + F.col("id") * 100_000
    rows = spark.range(40).coalesce(1).select("id", m.alias("mass_int"), (m - 475_000).alias("lo"), (m + 475_000).alias("hi"))
    made = decoys.generate(rows, "id", 3)
    assert made.select(F.spark_partition_id()).distinct().count() > 1 and made.count() == 120


def test_draws_of_decoys_stay():
    w = 475_000
    assert [decoys.decoy(950_000_000, 950_000_000 - w, 950_000_000 + w, random.Random(i)) for i in range(3)] == ["SCVPCACIR", "GWSCKGWK", "IYKLANDD"]


@pytest.mark.parametrize("name", ["variable_window_counts", "candidate_limit", "search_space_fasta", "decoy_fillup", "xcorr_score"])
def test_pairs_of_windows_and_masses_grow_with_the_tables(spark, copies, name, monkeypatch):
    join, met = C.mass_window_join, []

    def counted(*args, **named):
        found = join(*args, **named)
        met.append(found.count())
        return found

    monkeypatch.setattr(C, "mass_window_join", counted)
    totals = []
    for d in (DIR, copies):
        met.clear()
        catalog.QUERIES[name](spark, d)
        totals.append(sum(met))
    assert 0 < totals[1] < 1.8 * COPIES * totals[0], totals  # a row for each pair of copies would be COPIES ** 2


def test_tasks_of_a_top_up_grow_with_its_rows(spark, monkeypatch):
    monkeypatch.setattr(C, "ROWS_A_TASK", 100, raising=False)
    rows = spark.range(2000).select((F.col("id") % 500).alias("scan"), F.col("id").alias("decoy"))
    needed = spark.range(500).select(F.col("id").alias("scan"), (F.col("id") % 3).alias("needed"))
    got = C.top_up(rows.where("decoy % 2 = 0"), rows.where("decoy % 2 = 1"), needed.hint("merge"), ["scan"], ["decoy"])
    assert got.count() == sum(i % 3 for i in range(500))
    assert got.select(F.spark_partition_id()).distinct().count() > 10


def test_tasks_of_scores_grow_with_the_ions(spark, copies, monkeypatch):
    monkeypatch.setattr(xcorr, "IONS_A_TASK", 50, raising=False)
    got = catalog.QUERIES["xcorr_score"](spark, copies)
    assert got.select(F.spark_partition_id()).distinct().count() > 4  # the cores of the session


def _like_sql(spark, d, name):
    """The query's rows in their order, which are those of its SQL over tables of one or more files."""
    c = duckdb.connect()
    for f in glob.glob(f"{d}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f + '/*.parquet' if os.path.isdir(f) else f}'")
    want = c.execute(catalog.ORACLES[name])
    columns = [x[0] for x in want.description]
    df = catalog.QUERIES[name](spark, d)
    got = df.collect()
    assert rows(df.columns, [tuple(r) for r in got]) == rows(columns, want.fetchall())
    return got


def test_rows_of_an_entry_come_together(spark, copies):
    got = _like_sql(spark, copies, "search_space_fasta")
    runs = 1 + sum((a["peptide_id"], a["nr"]) != (b["peptide_id"], b["nr"]) for a, b in zip(got, got[1:]))
    assert runs < 0.6 * len(got), (runs, len(got))  # Parquet stores the columns of an entry as runs


@pytest.fixture(scope="module")
def repeated(spark, copies, tmp_path_factory):
    """``copies`` whose events come twice, half of them under keys of their own and the last without one."""
    out = str(tmp_path_factory.mktemp("repeated"))
    for f in glob.glob(f"{copies}/*.parquet"):
        os.symlink(f, f"{out}/{os.path.basename(f)}") if os.path.basename(f)[:-8] != "events" else None
    t = spark.read.parquet(f"{copies}/events.parquet")
    more = t.withColumn("event_id", F.when(F.col("event_id") % 2 == 0, F.col("event_id")).otherwise(F.col("event_id") + 1_000_000))
    alone = t.where("value between 230 and 240 and user_id % 5 = 2").limit(1).withColumn("event_id", F.lit(None).cast("long"))
    t.unionByName(more).unionByName(alone).coalesce(1).write.parquet(f"{out}/events.parquet")
    return out


def test_blocks_of_a_space_equal_sql(spark, repeated, monkeypatch):
    monkeypatch.setattr(catalog, "SCANS_A_BLOCK", 2, raising=False)
    monkeypatch.setattr(catalog, "ROWS_A_TASK", 40)
    assert any(r["scan"] is None for r in _like_sql(spark, repeated, "search_space_fasta"))


def test_repeated_rows_of_a_scan_share_their_entries(spark, repeated):
    got = _like_sql(spark, repeated, "search_space_fasta")
    runs = 1 + sum((a["peptide_id"], a["nr"]) != (b["peptide_id"], b["nr"]) for a, b in zip(got, got[1:]))
    assert runs < 0.6 * len(got), (runs, len(got))
