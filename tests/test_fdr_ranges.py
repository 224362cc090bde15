"""Rates by ranges equal those of one window a group: a group larger than a range, null groups and scores, ties, no rows."""

import random

from ionloom.operators import fdr
from ionloom.session import written


def test_ranged_equals_window(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice([*"aaaaaaab", None]), rng.choice([None, 0.5, 1.0, rng.random() * 3]), rng.choice(["decoy", "target", None])) for i in range(600)]
    df = spark.createDataFrame(rows, "i long, run string, xcorr double, kind string").withColumn("is_target", fdr.F.col("kind") == "target")
    for by in (["run"], ["run", "kind"], []):
        got = fdr.fdr_ranged(df, by, "xcorr", ["i"], written)
        want = fdr.fdr_by(df, by, "xcorr", ["i"]).withColumn("decoys", fdr.F.coalesce("decoys", fdr.F.lit(0))).withColumn("fdr", fdr.F.col("decoys") / fdr.F.col("rank"))
        cols = ["i", "run", "xcorr", "decoys", "rank", "fdr"]
        assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(map(tuple, want.select(cols).collect()), key=str)
    assert fdr.fdr_ranged(df.limit(0), ["run"], "xcorr", ["i"], written).count() == 0
