"""Projections of the driver's tables onto spectra, library, peaks, peptides, matches and features.

Each view is a pair: a DataFrame and the SQL of the same rows for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionloom.constants import PROTON, SCALE
from ionloom.operators import precursors as P


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def precursor(spark: SparkSession, d: str) -> DataFrame:
    """events: event_id is the scan, user_id the run; masses that aren't positive are left out."""
    e = table(spark, d, "events").select(F.col("event_id").alias("scan"), F.col("user_id").alias("run"), F.col("value").alias("mz"), (F.lit(2) + F.col("user_id") % 5).cast("long").alias("charge"))
    return e.withColumn("mass", P.neutral_mass(F.col("mz"), F.col("charge"))).where("mass > 0").withColumn("mass_int", P.mass_int(F.col("mass")))


PRECURSOR = f"""SELECT *, CAST(round(mass * {SCALE}) AS BIGINT) AS mass_int FROM (
  SELECT event_id AS scan, user_id AS run, value AS mz, CAST(2 + user_id % 5 AS BIGINT) AS charge,
    value * (2 + user_id % 5) - (2 + user_id % 5) * CAST({PROTON} AS DOUBLE) AS mass FROM events) WHERE mass > 0"""


def library(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("peptide_id"), F.upper(F.regexp_replace("p_name", "[^a-z]", "")).alias("peptide"), P.mass_int(F.col("p_retailprice")).alias("library_mass"))


LIBRARY = f"SELECT p_partkey AS peptide_id, upper(regexp_replace(p_name, '[^a-z]', '', 'g')) AS peptide, CAST(round(p_retailprice * {SCALE}) AS BIGINT) AS library_mass FROM part"


def peptides(spark: SparkSession, d: str) -> DataFrame:
    """Distinct words of all documents, upper-cased, of two residues or more and nothing else."""
    words = table(spark, d, "documents").select(F.explode(F.split("text", " ")).alias("w"))
    return words.where(F.col("w").rlike("^[A-Za-z]{2,}$")).select(F.upper("w").alias("sequence")).where(~F.col("sequence").rlike("[BJOUXZ]")).distinct()


PEPTIDES = r"""SELECT DISTINCT upper(w) AS sequence FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents)
  WHERE regexp_matches(w, '^[A-Za-z]{2,}$') AND NOT regexp_matches(upper(w), '[BJOUXZ]')"""


def sequences(spark: SparkSession, d: str) -> DataFrame:
    """The residue letters of every whole document."""
    keep = F.upper(F.regexp_replace(F.coalesce("text", F.lit("")), "[^ACDEFGHIKLMNPQRSTVWYacdefghiklmnpqrstvwy]", ""))
    return table(spark, d, "documents").select("doc_id", keep.alias("sequence"))


SEQUENCES = "SELECT doc_id, upper(regexp_replace(coalesce(text, ''), '[^ACDEFGHIKLMNPQRSTVWYacdefghiklmnpqrstvwy]', '', 'g')) AS sequence FROM documents"


def peaks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").alias("scan"), F.col("value").alias("mz"), F.get_json_object("props", "$.k").cast("double").alias("intensity"))


PEAKS = "SELECT user_id AS scan, value AS mz, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS intensity FROM events"


def psms(spark: SparkSession, d: str) -> DataFrame:
    item, part = table(spark, d, "lineitem"), table(spark, d, "part").select("p_partkey", "p_retailprice")
    mark = F.when(F.col("l_returnflag") == "R", F.lit("moy")).otherwise(F.lit("mdb"))
    return item.join(part, item.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").alias("scan"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("peptide_id"), F.col("l_suppkey").alias("run"),
        F.concat(mark, F.lit("|"), F.col("l_partkey").cast("string")).alias("protein"), F.col("l_extendedprice").alias("xcorr"),
        F.col("l_quantity").cast("long").alias("ions_matched"), F.lit(50).cast("long").alias("ions_total"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("experimental_mass"), F.col("p_retailprice").alias("theoretical_mass"), "l_discount", "l_tax", "l_shipdate", "l_linestatus",
    )


PSMS = """SELECT l_orderkey AS scan, l_linenumber AS line, l_partkey AS peptide_id, l_suppkey AS run,
  CASE WHEN l_returnflag = 'R' THEN 'moy' ELSE 'mdb' END || '|' || CAST(l_partkey AS VARCHAR) AS protein, l_extendedprice AS xcorr,
  CAST(l_quantity AS BIGINT) AS ions_matched, CAST(50 AS BIGINT) AS ions_total, l_extendedprice / l_quantity AS experimental_mass,
  p_retailprice AS theoretical_mass, l_discount, l_tax, l_shipdate, l_linestatus FROM lineitem JOIN part ON l_partkey = p_partkey"""

#: Ties of the match order, so that it is total but for repeated rows.
PSM_TIES = ["scan", "line", "peptide_id", "run", "protein", "ions_matched", "l_discount", "l_tax", "l_shipdate", "l_linestatus"]


def features(spark: SparkSession, d: str) -> DataFrame:
    v = lambda i: F.get("embedding", F.lit(i)).cast("double").alias(f"f{i}")
    return table(spark, d, "embeddings").select("vec_id", F.col("label").alias("grp"), v(0), v(1), v(2))


FEATURES = "SELECT vec_id, label AS grp, CAST(embedding[1] AS DOUBLE) AS f0, CAST(embedding[2] AS DOUBLE) AS f1, CAST(embedding[3] AS DOUBLE) AS f2 FROM embeddings"
