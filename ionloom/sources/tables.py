"""Table sources: modifications, peptide libraries, match tables and result folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionloom.constants import PSM_SCHEMA
from ionloom.operators.ptm import PTM_SCHEMA

LIBRARY_SCHEMA = "bin_width long, partition long, mass long, sequence string, missed_cleavages short"


def read_ptms(spark: SparkSession, path: str) -> DataFrame:
    """Modifications from CSV with a header; two static ones of the same residue and position are an error."""
    ptms = spark.read.csv(path, header=True, schema=PTM_SCHEMA, mode="FAILFAST")
    twice = ptms.where("mod_type = 'Static'").groupBy("amino_acid", "position").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"several static modifications of {twice[0].amino_acid} at {twice[0].position}")
    return ptms


def read_library(spark: SparkSession, path: str, max_mass: int | None = None, min_mass: int | None = None) -> DataFrame:
    """Peptides; mass bounds prune the folders of ``write_library`` and reach the Parquet scan.

    Folders without a bin width, as other writers leave them, are read by the mass alone.
    """
    return within(spark.read.schema(LIBRARY_SCHEMA).parquet(path), min_mass, max_mass)


def within(rows: DataFrame, min_mass: int | None, max_mass: int | None) -> DataFrame:
    """Library rows of the masses from ``min_mass`` to ``max_mass``; the folders, where the table has them, are pruned."""
    folder = lambda mass: F.floor(F.lit(mass) / F.col("bin_width"))
    folders = "bin_width" in rows.columns
    for mass, keep in ((min_mass, lambda a, b: a >= b), (max_mass, lambda a, b: a <= b)):
        if mass is not None:
            rows = rows.where(F.coalesce(keep(F.col("partition"), folder(mass)), F.lit(True))) if folders else rows
            rows = rows.where(keep(F.col("mass"), mass))
    return rows


def write_library(peptides: DataFrame, path: str, bin_width: int) -> None:
    """Peptides in folders by mass range, under the width of the ranges, and sorted in them."""
    rows = peptides.withColumn("bin_width", F.lit(bin_width).cast("long")).withColumn("partition", F.floor(F.col("mass") / bin_width))
    rows.repartition("partition").sortWithinPartitions("partition", "mass").write.partitionBy("bin_width", "partition").mode("overwrite").parquet(path)


def read_psms(spark: SparkSession, path: str) -> DataFrame:
    """Matches from tab-separated files with a header; empty files have no rows."""
    return spark.read.csv(path, sep="\t", header=True, schema=PSM_SCHEMA, enforceSchema=False)


def read_goodness(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema="test_name string, distribution string, statistic double, p_value double")


def run_listing(results: DataFrame) -> DataFrame:
    """Runs of each search with their spectra, from a table partitioned by uuid and ms_run."""
    return results.groupBy("uuid", "ms_run").agg(F.countDistinct("spectrum_id").alias("spectra"))
