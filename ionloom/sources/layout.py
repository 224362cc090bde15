"""Libraries in folders of about equal size by mass quantiles, with a configuration row and a filter of their sequences.

``_configuration`` and ``_filter`` lie inside the library's folder; Spark passes over such names when it reads the peptides.  A library without
them is read as before, by its masses alone.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ionloom.operators.membership import TargetFilter, build_filter
from ionloom.sources.sinks import exists

CONFIGURATION = "partition_limits array<long>, peptides long, filter_blocks long"
#: Partitions are numbered by a scan of the limits, so there are not to be too many.
MAX_PARTITIONS = 1000


@dataclass(frozen=True)
class Layout:
    limits: tuple[int, ...]
    peptides: int
    known: TargetFilter


def quantile_limits(rows: DataFrame, partitions: int, mass: str = "mass", accuracy: int = 10_000) -> list[int]:
    """Upper masses of all partitions but the last, rising; fewer where many peptides have one mass.  They come from a mergeable sketch."""
    if not 1 <= partitions <= MAX_PARTITIONS:
        raise ValueError(f"1 to {MAX_PARTITIONS} partitions")
    if partitions == 1:
        return []
    found = rows.agg(F.percentile_approx(mass, [k / partitions for k in range(1, partitions)], accuracy).alias("limits")).first().limits
    return sorted(set(found or []))


def partition_of(mass: Column, limits: list[int] | tuple[int, ...]) -> Column:
    """Number of the first limit that the mass doesn't exceed; the last partition takes the rest."""
    if not limits:
        return F.when(mass.isNotNull(), F.lit(0).cast("long"))
    return F.when(mass.isNotNull(), F.size(F.filter(F.array(*(F.lit(x).cast("long") for x in limits)), lambda x: x < mass)).cast("long"))


def touched_partitions(windows: DataFrame, limits: list[int] | tuple[int, ...]) -> DataFrame:
    """The partitions that windows from ``lo`` to ``hi`` meet, each once: one row more than there are limits at most."""
    rows = windows.where("lo <= hi").select(F.explode(F.sequence(partition_of(F.col("lo"), limits), partition_of(F.col("hi"), limits))).alias("partition"))
    return rows.distinct()


def touched(library: DataFrame, windows: DataFrame, limits: list[int] | tuple[int, ...]) -> DataFrame:
    """Library rows of the partitions that windows meet; other folders aren't opened, as the join's few rows prune them when the plan runs."""
    return library.join(F.broadcast(touched_partitions(windows, limits)), "partition", "left_semi")


def between(library: DataFrame, limits: list[int] | tuple[int, ...], min_mass: int, max_mass: int) -> DataFrame:
    """Library rows of the masses from ``min_mass`` to ``max_mass``, from their folders only."""
    folders = F.col("partition").between(bisect_left(limits, min_mass), bisect_left(limits, max_mass))
    return library.where(folders & F.col("mass").between(min_mass, max_mass))


def write_laid_out(peptides: DataFrame, path: str, partitions: int) -> Layout:
    """Peptides (mass, sequence, missed_cleavages) by quantiles of their masses, with configuration and filter.

    The configuration is written last: a write that was cut off leaves a library without one.  Peptides without a mass are refused by no one but
    match nothing; they lie in the folder of the null partition.
    """
    spark, limits = peptides.sparkSession, quantile_limits(peptides, partitions)
    rows = peptides.withColumn("partition", partition_of(F.col("mass"), limits))
    rows.repartition("partition").sortWithinPartitions("partition", "mass").write.partitionBy("partition").mode("overwrite").parquet(path)
    stored = spark.read.schema("mass long, sequence string, missed_cleavages short, partition long").parquet(path)
    n, known = stored.count(), build_filter(stored)
    known.rows.write.mode("overwrite").parquet(f"{path}/_filter")
    spark.createDataFrame([(limits, n, known.blocks)], CONFIGURATION).coalesce(1).write.mode("overwrite").parquet(f"{path}/_configuration")
    return read_layout(spark, path)


def read_layout(spark: SparkSession, path: str) -> Layout | None:
    """The layout of a library, or None if it has no configuration."""
    if not exists(spark, f"{path}/_configuration"):
        return None
    row = spark.read.schema(CONFIGURATION).parquet(f"{path}/_configuration").first()
    known = spark.read.schema("block long, words array<long>").parquet(f"{path}/_filter")
    return Layout(tuple(row.partition_limits), row.peptides, TargetFilter(known, row.filter_blocks))
