"""Very many equal rows under one id or without one are one text of the suffix search."""

import glob
import hashlib

from pyspark.sql import functions as F

from ionloom.llm import suffix_dedup
from tests.llm.conftest import prose


def test_equal_rows_are_one_live_text(spark):
    import random

    rng = random.Random(2)
    shared, tail = prose(rng, 60), prose(rng, 80)
    many = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 7).cast("long").alias("doc_id"), F.lit(f"{shared} {tail}").alias("text"))
    few = spark.createDataFrame([(8, f"start {shared} end"), (9, "clean and short"), (None, "clean and short"), (10, "clean and short")], "doc_id long, text string")
    before = set(glob.glob(spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/suffix-live-*"))
    found = {bytes(r.key): r for r in suffix_dedup.repeated_spans(many.unionAll(few)).collect()}
    (live,) = set(glob.glob(spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/suffix-live-*")) - before
    assert spark.read.parquet(live).count() == 2
    key = lambda text: hashlib.sha256(text.encode()).digest()
    assert found[key(f"{shared} {tail}")].n_removed == len(f"{shared} {tail}")
    # the blanks around the passage are shared only where the other text has them as well: in front it starts a text there
    assert found[key(f"start {shared} end")].n_removed == len(shared) + 1 and found[key("clean and short")].n_removed == 0
    assert len(found) == 3
