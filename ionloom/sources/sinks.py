"""Sinks: matches, candidate lists, FASTA, metrics, errors and the decoy cache."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ionloom.functions.naming import fasta_entry

METRICS = {"search_space_generation": ("time", "size", "len"), "identification": ("time", "len"), "scoring": ("time",)}


def write_psms(psms: DataFrame, path: str, mode: str = "overwrite", batch: int | None = None) -> None:
    """zstd Parquet by search and run; only the partitions at hand are replaced, so a repeated write changes nothing.

    A stream gives its ``batch`` number, a partition column below the run: a run's spectra may come in several batches, and a
    repeated batch replaces its own rows only.
    """
    keys = ["uuid", "ms_run"] if batch is None else ["uuid", "ms_run", "batch"]
    psms = psms if batch is None else psms.withColumn("batch", F.lit(batch).cast("long"))
    out = psms.repartition("uuid", "ms_run", F.pmod(F.xxhash64("spectrum_id"), F.lit(16))).sortWithinPartitions("uuid", "ms_run", "spectrum_id")
    out.write.partitionBy(*keys).option("compression", "zstd").option("partitionOverwriteMode", "dynamic").mode(mode).parquet(path)


def write_candidates(candidates: DataFrame, path: str, batch: int | None = None) -> None:
    """One peptide a line, by search and run (and batch of a stream); only the partitions at hand are replaced."""
    keys = ["uuid", "ms_run"] if batch is None else ["uuid", "ms_run", "batch"]
    rows = candidates if batch is None else candidates.withColumn("batch", F.lit(batch).cast("long"))
    rows.select(*keys, F.col("peptide").alias("value")).write.partitionBy(*keys).option("partitionOverwriteMode", "dynamic").mode("overwrite").text(path)


def replace_batch(rows: DataFrame, path: str, batch: int | str, keys: tuple[str, ...] = (), kind: str = "parquet") -> None:
    """What a stream's batch (or a search that is no stream, under its name) has for a side table: all that it left there before is replaced."""
    rows.write.partitionBy(*keys).mode("overwrite").format(kind).save(f"{path}/batch={batch}")


def fasta(candidates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """FASTA entries, targets and decoys numbered from 1 each."""
    nr = F.row_number().over(Window.partitionBy(*keys, "is_target").orderBy(*order))
    rows = candidates.withColumn("nr", nr)
    entry = F.when(F.col("is_target"), fasta_entry(F.col("peptide"), F.col("nr"), True)).otherwise(fasta_entry(F.col("peptide"), F.col("nr"), False))
    return rows.select(*keys, "is_target", "nr", entry.alias("entry"))


def write_fasta(candidates: DataFrame, path: str, keys: list[str], order: list[str]) -> None:
    fasta(candidates, keys, order).select(F.rtrim(F.col("entry"), F.lit("\n")).alias("value")).write.mode("overwrite").text(path)


def metrics_long(df: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """One row for each key and metric."""
    rows = F.array(*(F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in values.items()))
    return df.select(*keys, F.explode(rows).alias("m")).select(*keys, "m.*")


def error_level(uuid: Column, run: Column, spectrum: Column, precursor: Column) -> Column:
    """The deepest level that an error names."""
    return F.when(precursor.isNotNull(), "precursor").when(spectrum.isNotNull(), "spectrum").when(run.isNotNull(), "run").when(uuid.isNotNull(), "search")


def append_errors(errors: DataFrame, path: str) -> None:
    level = error_level(F.col("uuid"), F.col("ms_run"), F.col("spectrum_id"), F.col("precursor"))
    errors.withColumn("level", level).write.partitionBy("level").mode("append").json(path)


def write_errors(errors: DataFrame, path: str, batch: int | str) -> None:
    """Errors of a batch with their level; a repeated batch replaces its own."""
    level = error_level(F.col("uuid"), F.col("ms_run"), F.col("spectrum_id"), F.col("precursor"))
    replace_batch(errors.withColumn("level", level), path, batch, ("level",), "json")


def append_decoys(decoys: DataFrame, path: str) -> None:
    """New decoys are appended; ``read_decoys`` has each sequence once."""
    decoys.select("mass", "sequence", "missed_cleavages").write.mode("append").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, in the file system that it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_decoys(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("mass long, sequence string, missed_cleavages short").parquet(path).dropDuplicates(["sequence"])
