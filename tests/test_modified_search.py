"""Static modifications, filled-up decoys, known decoys, and what a local run leaves."""

import random

import pytest
from pyspark.sql import functions as F

from ionloom import cli
from ionloom.constants import PROTON, SCALE
from ionloom.functions.sequence import annotated, sequence_mass
from ionloom.operators import decoys, ptm
from ionloom.params import SearchParams
from ionloom.plans import search as S
from ionloom.sources import mzml, tables
from tests.test_operators import mzml_file

MODS = ptm.StaticModifications((("C", 57_021_464),), 42_010_565, 0)


def weight(spark, peptide, mods=ptm.UNMODIFIED):
    return spark.range(1).select(sequence_mass(F.lit(peptide), mods)).first()[0]


def spectra_of_mass(spark, mass, scans=2):
    mz = mass / SCALE / 2 + PROTON
    rows = [("u", "r", f"s{i}", 2, [200.0, 300.0], [1.0, 2.0], [(mz, 2)]) for i in range(scans)]
    return spark.createDataFrame(rows, mzml.SPECTRUM_SCHEMA)


def library_of(spark, *peptides):
    rows = spark.createDataFrame([(p,) for p in peptides], "sequence string")
    return rows.select(sequence_mass(F.col("sequence")).alias("mass"), "sequence", F.lit(0).cast("short").alias("missed_cleavages"))


def test_modified_peptides_are_found_at_their_mass(spark):
    library, p = library_of(spark, "ACDEFGHK", "ADEFGHHK"), SearchParams()
    with_mods, without = weight(spark, "ACDEFGHK", MODS), weight(spark, "ACDEFGHK")
    assert with_mods - without == 57_021_464 + 42_010_565
    names = lambda mass, mods: {r.peptide for r in S.candidate_rows(S.precursor_rows(spectra_of_mass(spark, mass), p), library, p, 10_000 * SCALE, mods=mods).collect()}
    assert names(with_mods, MODS) == {"ACDEFGHK"} and names(without, MODS) == set()
    assert names(without, ptm.UNMODIFIED) == {"ACDEFGHK"}
    assert spark.range(1).select(annotated(F.lit("ACDC"), MODS)).first()[0] == "AC[s57021464]DC[s57021464]"


def test_decoys_weigh_their_modifications(spark):
    target = weight(spark, "ACDEFGHKLMNPK", MODS)
    made = [decoys.decoy(target, target - 20_000, target + 20_000, random.Random(i), mods=MODS) for i in range(20)]
    assert any(made) and all(abs(weight(spark, x, MODS) - target) <= 20_000 for x in made if x)


def test_decoys_are_filled_up_behind_known_ones(spark):
    p = SearchParams(decoys_per_peptide=4, lower_mass_tolerance_ppm=200, upper_mass_tolerance_ppm=200)
    library = library_of(spark, "ACDEFGHIKLMNPK")
    rows = S.precursor_rows(spectra_of_mass(spark, weight(spark, "ACDEFGHIKLMNPK")), p)
    known = spark.createDataFrame([("CADEFGHIKLMNPK",), ("ACDEFGHIKLMNPK",), ("AAAAAAK",)], "sequence string")  # a decoy, a target, another mass
    got = S.candidate_rows(rows, library, p, 10_000 * SCALE, cached=known).collect()
    by = {}
    for r in got:
        by.setdefault((r.scan, r.is_target), []).append(r.peptide)
    assert len(by) == 4
    for (_, target), found in by.items():
        assert found == ["ACDEFGHIKLMNPK"] if target else (len(found) == 4 and "CADEFGHIKLMNPK" in found and "ACDEFGHIKLMNPK" not in found)


def test_what_is_not_searched_is_refused(spark):
    odd = spark.createDataFrame([("M", 15.99, "Variable", "Anywhere")], ptm.PTM_SCHEMA)
    with pytest.raises(ValueError):
        ptm.static_modifications(odd)
    fine = spark.createDataFrame([("C", 57.021464, "Static", "Anywhere"), ("", 42.010565, "Static", "Bond_N")], ptm.PTM_SCHEMA)
    assert ptm.static_modifications(fine) == MODS and ptm.static_modifications(fine.limit(0)) == ptm.UNMODIFIED


def test_local_run_leaves_matches_metrics_and_candidates(spark, tmp_path, capsys):
    mzml_file(tmp_path / "run.mzML")
    precursors = S.precursor_rows(mzml.read_spectra(spark, str(tmp_path / "run.mzML"), "u"), SearchParams())
    rows = precursors.select(F.col("mass_int").alias("mass"), F.lit("ACDEFGHK").alias("sequence"), F.lit(0).cast("short").alias("missed_cleavages"))
    tables.write_library(rows, str(tmp_path / "library"), 1_000_000)
    (tmp_path / "p.toml").write_text("[search_parameters]\nkeep_fasta_files = true\n")
    out = str(tmp_path / "out")
    assert cli.main(["local-run", str(tmp_path / "run.mzML"), str(tmp_path / "library"), out, "--uuid", "one", "--params", str(tmp_path / "p.toml")]) == 0
    found = spark.read.parquet(out).count()
    assert found and capsys.readouterr().out == f"one: {found} matches\n"
    metrics = spark.read.parquet(out + ".metrics")
    assert {r.metric for r in metrics.collect()} == {"size", "len"} and metrics.where("metric = 'len'").agg(F.sum("value")).first()[0] == found
    assert spark.read.text(out + ".candidates").count() == found


def test_index_without_ms2(spark, tmp_path):
    body = "".join(f'<spectrum index="{i}" id="scan={i}"><cvParam accession="{mzml.MS_LEVEL}" name="ms level" value="{level}"/></spectrum>' for i, level in enumerate((1, 2, 12, 2)))
    (tmp_path / "a.mzML").write_text(f"<mzML><run><spectrumList>{body}<spectrum id='x' /></spectrumList></run></mzML>")
    ids = lambda **k: [r.spectrum_id for r in mzml.spectrum_index(spark, str(tmp_path / "a.mzML"), **k).orderBy("offset").collect()]
    assert ids() == ["scan=0", "scan=1", "scan=2", "scan=3"] and ids(without_ms2=True) == ["scan=0", "scan=2"]
