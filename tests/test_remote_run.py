"""Spectra of one run that arrive in two batches keep all their matches."""

from pyspark.sql import functions as F

from ionloom import cli
from ionloom.constants import SCALE
from ionloom.functions import sequence
from ionloom.params import SearchParams
from ionloom.sources import mzml, sinks, tables
from tests.test_operators import mzml_file


def test_later_batch_keeps_earlier_matches(spark, tmp_path):
    mzml_file(tmp_path / "a.mzML")
    spectra = mzml.read_spectra(spark, str(tmp_path / "a.mzML"), "u")
    peptides = spark.createDataFrame([("PEPTIDEK",), ("SAMPLER",)], "sequence string")
    lib = peptides.select(sequence.sequence_mass(F.col("sequence")).alias("mass"), "sequence", F.lit(0).cast("short").alias("missed_cleavages"))
    tables.write_library(lib, str(tmp_path / "lib"), SCALE)
    (tmp_path / "p.toml").write_text(SearchParams(decoys_per_peptide=0, lower_mass_tolerance_ppm=200, upper_mass_tolerance_ppm=200).to_toml())
    for scan in ("scan=2", "scan=3"):
        spectra.where(F.col("spectrum_id") == scan).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        assert cli.main(["remote-run", str(tmp_path / "in"), str(tmp_path / "lib"), str(tmp_path / "out"), "--params", str(tmp_path / "p.toml")]) == 0
    found = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.batch, r.spectrum_id) for r in found.collect()} == {(0, "scan=2"), (1, "scan=3")}
    # a repeated batch replaces its own rows only
    n = found.count()
    found.where("batch = 1").drop("batch").write.parquet(str(tmp_path / "copy"))
    again = spark.read.parquet(str(tmp_path / "copy"))
    sinks.write_psms(again, str(tmp_path / "out"), batch=1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == n
