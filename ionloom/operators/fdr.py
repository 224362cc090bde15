"""Target marks and false-discovery rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ionloom.constants import DECOY_PREFIX


def mark_targets(df: DataFrame, protein: str = "protein") -> DataFrame:
    """``is_target``: the protein's name lacks the decoy prefix; null stays null."""
    return df.withColumn("is_target", ~F.col(protein).startswith(DECOY_PREFIX))


def _running(keys: list[Column], by: list[str]) -> tuple[Column, Column]:
    w = Window.partitionBy(*by).orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum((~F.col("is_target")).cast("long")).over(w), F.count(F.lit(1)).over(w)


def fdr_by(df: DataFrame, by: list[str], score: str, ties: list[str]) -> DataFrame:
    """Decoys over all rows so far in descending score (nulls last), within each group of ``by``; a group is one task's work.

    ``fdr_ranged`` gives the same for groups of any size.
    """
    decoys, rows = _running([F.desc_nulls_last(score), *map(F.col, ties)], by)
    return df.withColumn("decoys", decoys).withColumn("rank", rows).withColumn("fdr", F.col("decoys") / F.col("rank"))


def fdr_ranged(df: DataFrame, by: list[str], score: str, ties: list[str], written) -> DataFrame:
    """``fdr_by`` without a task that sees a whole group.

    Rows are range-partitioned by group and order and numbered by range; each range gets running counts of its own for each group, to
    which the sums of the group's ranges before it (one small row a range and group) are added.  A null mark is no decoy, a null in ``by`` is a group of
    its own.  ``written`` fixes the ranges between the two uses.
    """
    keys = [F.desc_nulls_last(score), *map(F.col, ties)]
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = written(df.repartitionByRange(n, *map(F.col, by), *keys).withColumn("range_no", F.spark_partition_id()))
    sums = ranged.groupBy("range_no", *by).agg(F.coalesce(F.sum((~F.col("is_target")).cast("long")), F.lit(0)).alias("d"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*by).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    d0, n0 = (F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c + "0") for c in ("d", "n"))
    offsets = sums.select(F.col("range_no").alias("range_0"), *(F.col(c).alias(f"by_{i}") for i, c in enumerate(by)), d0, n0)
    decoys, rows = _running(keys, ["range_no", *by])
    same = F.col("range_no") == F.col("range_0")
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"by_{i}"))
    # without groups there is one row a range; with them Spark's own check of size decides
    out = ranged.withColumn("d1", decoys).withColumn("n1", rows).join(offsets if by else F.broadcast(offsets), same)
    out = out.withColumn("decoys", F.col("d0") + F.coalesce("d1", F.lit(0))).withColumn("rank", F.col("n0") + F.col("n1"))
    return out.withColumn("fdr", F.col("decoys") / F.col("rank")).drop("range_no", "d0", "n0", "d1", "n1", "range_0", *(f"by_{i}" for i in range(len(by))))


def fdr_global(df: DataFrame, score: str, ties: list[str], written) -> DataFrame:
    """``fdr_ranged`` over the whole table as one group."""
    return fdr_ranged(df, [], score, ties, written)
