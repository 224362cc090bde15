"""Variable modifications against brute force, filled-up decoys with marks, streamed scores, and one parse of the spectra."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from ionloom import cli
from ionloom.constants import PROTON, RESIDUES, SCALE, WATER, mass_int
from ionloom.operators import decoys, fragments, ptm, scan_scores, variable, xcorr
from ionloom.params import SearchParams, XcorrParams
from ionloom.plans import search as S
from ionloom.sources import mzml, sinks, tables
from tests.test_modified_search import library_of, spectra_of_mass, weight
from tests.test_operators import mzml_file

V = variable.VariableModification
OXIDE, PHOSPHO = 15_994_915, 79_966_331
MODS = (V("M", OXIDE), V("M", 2 * OXIDE), V("S", PHOSPHO), V("S", PHOSPHO, "Terminus_N"), V("K", 42_010_565, "Terminus_C"), V("", 1_000_000, "Bond_N"), V("", -984_016, "Bond_C"))
STATIC = ptm.StaticModifications((("C", 57_021_464), ("S", 5_000_000)))


def plain_forms(seq, mods, most, static=()):
    """Every seating of up to ``most`` modifications: form and delta, by trying all choices at all places."""
    n = len(seq)
    choices = []
    for place in range(n + 2):
        here = [None]
        for v in mods:
            residue = 1 <= place <= n and seq[place - 1] == v.residue and v.residue not in static
            fits = {"Anywhere": residue, "Terminus_N": residue and place == 1, "Terminus_C": residue and place == n, "Bond_N": place == 0, "Bond_C": place == n + 1}[v.position]
            if fits:
                here.append(v)
        choices.append(here)
    out = []
    for picked in itertools.product(*choices):
        if sum(v is not None for v in picked) > most:
            continue
        mark = [f"[v{v.delta}]" if v else "" for v in picked]
        form = (mark[0] + "-" if mark[0] else "") + "".join(a + m for a, m in zip(seq, mark[1:-1], strict=True)) + ("-" + mark[-1] if mark[-1] else "")
        out.append((seq, form, sum(v.delta for v in picked if v)))
    return out


@pytest.mark.parametrize("most", [0, 1, 3])
@pytest.mark.parametrize("static", [ptm.UNMODIFIED, STATIC])
def test_forms_match_all_choices(spark, most, static):
    peptides = ["MMSK", "SAMPLER", "S", "K", "AAAA", "SMSMK", "MSMSMSK"]
    top = F.lit(1 << 60)
    rows = spark.createDataFrame([(p,) for p in peptides], "sequence string").withColumns({"mass_int": top, "lo": top, "hi": top})
    got = variable.forms(variable.shifted_windows(rows, MODS, most), "sequence", MODS, most, static).select("sequence", "form", "delta").collect()
    want = [x for p in peptides for x in plain_forms(p, MODS, most, dict(static.residues))]
    # two modifications of one delta at one place are two seatings of one form
    assert sorted(map(tuple, got)) == sorted(want)
    assert {r.sequence for r in spark.createDataFrame(got).select(variable.plain(F.col("form")).alias("sequence")).collect()} == set(peptides)


def test_combinations_are_bounded():
    assert len(variable.multisets(MODS[:3], 3)) == 1 + 3 + 6 + 10
    assert variable.multisets(MODS[-1:], 3) == [(), (0,)]
    with pytest.raises(ValueError):
        variable.multisets(tuple(V(a, i) for i, a in enumerate(RESIDUES)), 5)


def test_modification_table(spark):
    rows = [("M", 15.994915, "Variable", "Anywhere"), ("M", 15.994915, "Variable", "Anywhere"), (None, 1.0, "Variable", "Bond_N"), ("C", 57.021464, "Static", "Anywhere")]
    assert variable.variable_modifications(spark.createDataFrame(rows, ptm.PTM_SCHEMA)) == (V("M", OXIDE), V("", 1_000_000, "Bond_N"))
    for bad in (("M", 1.0, "Variable", "Bond_N"), ("", 1.0, "Variable", "Anywhere"), ("M", 1.0, "Variable", "Middle")):
        if bad[3] != "Bond_N":
            with pytest.raises(ValueError):
                variable.variable_modifications(spark.createDataFrame([bad], ptm.PTM_SCHEMA))


def test_marked_ions(spark):
    forms = ["[v1000000]-AM[v15994915]SK-[v-984016]", "AMSK"]
    rows = spark.createDataFrame([(f, f) for f in forms], "key string, form string")
    got = {(r.key, r.kind, r.number): round(r.mz, 6) for r in fragments.ions(rows, "key", sequence="form", marked=True).collect()}
    a, m, s, k = (mass_int(RESIDUES[x]) for x in "AMSK")
    at = lambda x: round(x / SCALE + PROTON, 6)
    assert got[forms[0], "B", 1] == at(a + 1_000_000) and got[forms[0], "B", 2] == at(a + m + 1_000_000 + OXIDE)
    assert got[forms[0], "Y", 1] == at(k - 984_016 + mass_int(WATER)) and got[forms[0], "Y", 3] == at(m + s + k + OXIDE - 984_016 + mass_int(WATER))
    assert got[forms[1], "B", 2] == at(a + m) and len(got) == 12
    for f in forms:
        masses = scan_scores.residue_masses(f, ptm.UNMODIFIED.masses())
        assert masses.sum() == a + m + s + k + (16_010_899 if "[" in f else 0)


def test_forms_are_found_at_their_mass(spark):
    library, p = library_of(spark, "AMDEFGMK", "ADEFGHHK"), SearchParams(max_variable_modifications=2)
    mods = (V("M", OXIDE),)
    plain = weight(spark, "AMDEFGMK")
    names = lambda mass: {r.peptide for r in S.candidate_rows(S.precursor_rows(spectra_of_mass(spark, mass), p), library, p, 10_000 * SCALE, variable=mods).collect()}
    assert names(plain) == {"AMDEFGMK"}
    assert names(plain + OXIDE) == {"AM[v15994915]DEFGMK", "AMDEFGM[v15994915]K"}
    assert names(plain + 2 * OXIDE) == {"AM[v15994915]DEFGM[v15994915]K"} and names(plain + 3 * OXIDE) == set()


def test_decoys_mirror_the_modifications_of_targets(spark):
    p = SearchParams(decoys_per_peptide=3, lower_mass_tolerance_ppm=100, upper_mass_tolerance_ppm=100, max_variable_modifications=2)
    library, mods = library_of(spark, "AMDEFGMLKVSTK"), (V("M", OXIDE), V("", 42_010_565, "Bond_N"), V("S", PHOSPHO))
    for delta, forms in ((OXIDE + PHOSPHO, 2), (42_010_565, 1)):
        rows = S.precursor_rows(spectra_of_mass(spark, weight(spark, "AMDEFGMLKVSTK") + delta), p)
        space = S.search_space(rows, library, p, 10_000 * SCALE, variable=mods)
        got = space.candidates.collect()
        assert space.short.count() == 0
        for scan in {r.scan for r in got}:
            mine = [r for r in got if r.scan == scan]
            made = [r for r in mine if not r.is_target]
            assert len(mine) - len(made) == forms and len(made) == 3 * forms == len({r.peptide for r in made})
            for r in made:
                marks = sum(int(x) for x in scan_scores._MARK.findall(r.peptide))
                bare = "".join(scan_scores._TOKEN.findall(r.peptide))
                assert marks == delta and bare == r.peptide
                mass = scan_scores.residue_masses(r.peptide, ptm.UNMODIFIED.masses()).sum() + mass_int(WATER)
                assert mass == r.library_mass and abs(mass - weight(spark, "AMDEFGMLKVSTK") - delta) <= (mass + delta) // 10_000


def test_decoys_with_residues_they_need():
    parts = ptm.UNMODIFIED.masses()
    target = sum(parts[a] for a in "MSTAGFLDEVK") + mass_int(WATER)
    for i in range(20):
        made = decoys.decoy(target, target - 50_000, target + 50_000, random.Random(i), needs="MM", first="S", last="T")
        assert made is None or (made[0] == "S" and made[-1] == "T" and made.count("M") >= 2 and abs(sum(parts[a] for a in made) + mass_int(WATER) - target) <= 50_000)
    assert any(decoys.decoy(target, target - 50_000, target + 50_000, random.Random(i), needs="MM", first="S", last="T") for i in range(20))


def test_a_scan_without_decoys_is_an_error(spark):
    p = SearchParams(decoys_per_peptide=2, lower_mass_tolerance_ppm=10, upper_mass_tolerance_ppm=10)
    library = library_of(spark, "GGGG")  # too light for a decoy of six residues
    found = S.find(spectra_of_mass(spark, weight(spark, "GGGG"), 1), library, p, 10_000 * SCALE)
    assert [r.error for r in found.errors.collect()] == ["2 decoys missing"]
    assert [r.peptide for r in found.matches.collect()] == ["GGGG"]


def test_new_decoys_join_the_known_ones_once(spark, tmp_path):
    p = SearchParams(decoys_per_peptide=5, lower_mass_tolerance_ppm=100, upper_mass_tolerance_ppm=100)
    library, cache = library_of(spark, "ACDEFGHIKLMNPK"), str(tmp_path / "cache")
    rows = S.precursor_rows(spectra_of_mass(spark, weight(spark, "ACDEFGHIKLMNPK"), 1), p)
    space = S.search_space(rows, library, p, 10_000 * SCALE)
    sinks.append_decoys(space.new_decoys, cache)
    known = sinks.read_decoys(spark, cache)
    assert known.count() == 5 and all(r.mass == weight(spark, r.sequence) for r in known.collect())
    again = S.search_space(rows, library, p, 10_000 * SCALE, cached=known, seed=99)
    assert again.new_decoys.count() == 0
    assert {r.peptide for r in again.candidates.where("not is_target").collect()} == {r.sequence for r in known.collect()}


@pytest.mark.parametrize("flanks,losses", [(True, False), (False, True)])
def test_streamed_scores_equal_the_relational_ones(spark, flanks, losses):
    x = XcorrParams(bin_size=1.0005, use_flanking_peaks=flanks, max_fragment_charge=2, background=20, use_neutral_loss_ions=losses)
    rng = random.Random(1)
    rows = [(f"s{i}", "u", "r", f"s{i}", 0, 500.0, 1 + i, 900.0, [rng.uniform(50, 900) for _ in range(n)], [rng.uniform(0, 9) for _ in range(n)]) for i, n in enumerate((300, 1, 0, 40))]
    rows = spark.createDataFrame(rows, "scan string, uuid string, ms_run string, spectrum_id string, precursor_no int, precursor_mz double, charge int, precursor_da double, mz array<double>, intensity array<double>")
    forms = ["AMSK", "AM[v15994915]SK", "[v1000000]-AMSKPEPTIDEK", "K", "", "BXZ"]
    some = spark.createDataFrame([(f"s{i}", f, True, 5) for i in range(5) for f in forms], "scan string, peptide string, is_target boolean, library_mass long")
    got = {(r.spectrum_id, r.peptide): (round(r.xcorr, 9), r.ions_total, r.ions_matched) for r in scan_scores.scored(rows, some, x, STATIC).collect()}
    peaks = rows.select("scan", F.explode(F.arrays_zip("mz", "intensity")).alias("k")).select("scan", "k.*")
    heights = xcorr.normalised(xcorr.binned(peaks, x), x)
    listed = some.select(F.col("peptide").alias("form")).distinct().withColumn("key", F.col("form"))
    ions = fragments.ions(listed, "key", x.ions, 2, sequence="form", mods=STATIC, marked=True)
    ions = ions.unionByName(fragments.loss_ions(listed, "key", x.ions, 2, sequence="form", mods=STATIC, marked=True)) if losses else ions
    limits = rows.select("scan", F.greatest(F.least(F.col("charge") - 1, F.lit(2)), F.lit(1)).alias("top"))
    bins = some.join(limits, "scan").join(ions.withColumnRenamed("key", "peptide").withColumnRenamed("charge", "z"), "peptide").where("z <= top").select("scan", "peptide", xcorr.bin_of(F.col("mz"), x).alias("bin"))
    want = {(r.scan, r.peptide): (round(r.xcorr, 9), r.ions_total, r.ions_matched) for r in xcorr.scores(heights, bins, x).collect()}
    assert got.keys() == want.keys() and len(got) == 16
    for k, v in want.items():
        assert got[k] == (pytest.approx(v[0], abs=1e-8), *v[1:])


def test_files_are_parsed_once_and_scores_shuffle_once(spark, tmp_path):
    mzml_file(tmp_path / "a.mzML")
    p = SearchParams(decoys_per_peptide=1, lower_mass_tolerance_ppm=200, upper_mass_tolerance_ppm=200)
    found = S.find(mzml.read_spectra(spark, str(tmp_path / "a.mzML"), "u"), library_of(spark, "PEPTIDEK", "SAMPLER"), p, 10_000 * SCALE)
    for df in (found.matches, found.errors, found.space.candidates):
        assert "Scan text" not in df._jdf.queryExecution().optimizedPlan().toString() and "text" not in df._jdf.queryExecution().executedPlan().toString().lower().split("batchscan")[0]
    plan = S.match_rows(found.rows, found.space.candidates, p)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("MapInArrow") == 1
    found.discard()


def test_local_run_with_variable_modifications(spark, tmp_path):
    mzml_file(tmp_path / "run.mzML")
    precursors = S.precursor_rows(mzml.read_spectra(spark, str(tmp_path / "run.mzML"), "u"), SearchParams())
    mass = precursors.first().mass_int
    lib = spark.createDataFrame([("AMDEFGHK",)], "sequence string").select(F.lit(mass - OXIDE - 0).cast("long").alias("mass"), "sequence", F.lit(0).cast("short").alias("missed_cleavages"))
    tables.write_library(lib, str(tmp_path / "library"), 1_000_000)
    (tmp_path / "ptms.csv").write_text("amino_acid,mass_delta,mod_type,position\nM,15.994915,Variable,Anywhere\n")
    out = str(tmp_path / "out")
    (tmp_path / "p.toml").write_text("[search_parameters]\nkeep_fasta_files = true\n")
    for name in ("one", "two", "two"):
        assert cli.main(["local-run", str(tmp_path / "run.mzML"), str(tmp_path / "library"), out, "--uuid", name, "--ptms", str(tmp_path / "ptms.csv"), "--params", str(tmp_path / "p.toml")]) == 0
    got = spark.read.parquet(out)
    assert {r.peptide for r in got.collect()} == {"AM[v15994915]DEFGHK"}
    # both searches keep what they left, and the repeated one left it once
    for side, rows in ((".candidates", got.count()), (".metrics", 2 * got.count()), (".finished", 2 * got.where("uuid = 'one'").select("spectrum_id").distinct().count())):
        read = spark.read.text(out + side) if side == ".candidates" else spark.read.parquet(out + side)
        assert read.count() == rows, side
    assert {r.uuid for r in spark.read.text(out + ".candidates").select("uuid").distinct().collect()} == {"one", "two"}
    assert {r.stage for r in spark.read.parquet(out + ".times").collect()} == {"spectra", "search_space_generation", "identification", "scoring"}


def test_searches_with_parameters_of_their_own(spark):
    near = weight(spark, "ACDEFGHK")
    spectra = spectra_of_mass(spark, near + near // 20_000, 1)  # 50 ppm off
    both = spectra.unionAll(spectra.withColumn("uuid", F.lit("wide"))).unionAll(spectra.withColumn("uuid", F.lit("strict"))).unionAll(spectra.withColumn("uuid", F.lit(None).cast("string")))
    rows = [("wide", 1, None, 10, 10, None, None, None), ("wide", 2, None, 100, 100, None, 2, None), ("strict", 7, None, 100, 100, None, None, 1e9), (None, 1, None, 500, 500, None, None, None)]
    params = spark.createDataFrame(rows, S.PARAMS)
    found = S.find(both, library_of(spark, "ACDEFGHK"), SearchParams(), 10_000 * SCALE, params=params)
    got = found.matches.collect()
    assert {(r.uuid, r.is_target) for r in got} == {("wide", True), ("wide", False)} and len(got) == 3
    assert not {"lower_mass_tolerance_ppm", "least"} & set(found.matches.columns)
