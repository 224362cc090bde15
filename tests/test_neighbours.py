"""Outlier probabilities of groups of any size against the scores of one group in memory."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ionloom.operators import loop, neighbours


def points(spark):
    rng = np.random.default_rng(4)
    rows = []
    for g, n in (("big", 700), ("small", 9), ("one", 1), ("flat", 30), (None, 40), ("ties", 200)):
        x = rng.normal(size=(n, 3)) if g != "flat" else np.ones((n, 3))
        x = np.round(x) if g == "ties" else x
        rows += [(g, i, *map(float, v)) for i, v in enumerate(x)]
    rows += [("big", 1000, None, 1.0, 1.0), ("small", 1000, float("nan"), 0.0, 0.0)]
    return spark.createDataFrame(rows, "k string, i long, f0 double, f1 double, f2 double")


@pytest.mark.parametrize("k,size", [(5, 16), (20, 64), (1000, 50), (20, 1024)])
def test_blocks_give_the_scores_of_whole_groups(spark, k, size):
    df = points(spark)
    got = {}
    for r in loop.with_loop(df, ["k"], ["f0", "f1", "f2"], ["i"], k=k, size=size).collect():
        got.setdefault(r.k, []).append(r)
    assert sum(map(len, got.values())) == df.count()
    for rows in got.values():
        whole = sorted((r for r in rows if r.f0 is not None and not math.isnan(r.f0)), key=lambda r: r.i)
        want = loop.loop_scores(np.array([[r.f0, r.f1, r.f2] for r in whole]), k)
        for column, values in zip(("plof", "nplof", "loop_score"), want, strict=True):
            assert np.allclose([r[column] for r in whole], values, atol=1e-9), column
        assert all(r.plof is None and r.loop_score is None for r in rows if r not in whole)


def test_far_blocks_are_not_paired(spark):
    rows = spark.range(20_000).select(F.lit("g").alias("grp"), F.col("id").alias("row"), F.randn(1).alias("a"), F.randn(2).alias("b"), F.randn(3).alias("c"))
    packed = neighbours.blocks(rows, ["a", "b", "c"], 40).cache()
    n = packed.count()
    assert packed.agg(F.sum("n")).first()[0] == 20_000 and packed.agg(F.max("n")).first()[0] <= 40
    # a radius of a box's diagonal reaches some 80 boxes in three dimensions, however many there are
    assert neighbours.partners(packed, 10).count() < 0.25 * n * n and n > 500
    packed.unpersist()


def test_a_group_of_100_000_rows(spark):
    df = spark.range(100_000).select(F.lit(1).alias("k"), "id", F.rand(1).alias("a"), F.rand(2).alias("b"))
    got = loop.with_pdist(df, ["k"], ["a", "b"], ["id"], k=10).orderBy("id").limit(3).collect()
    x = np.array([[r.a, r.b] for r in df.orderBy("id").collect()])
    for r in got:
        d = np.sort(((x - x[r.id]) ** 2).sum(1))[1:11]
        assert r.pdist == pytest.approx(3 * math.sqrt(d.mean()))


def test_error_function(spark):
    xs = [0.0, 1e-9, 0.3, 1.0, 2.5, 4.0, 5.9, 6.0, 40.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(loop.erf(F.col("x"))).collect()]
    assert got == pytest.approx([math.erf(x) for x in xs], abs=1e-14)
