"""Hand-computed cases, properties and brute-force comparisons of the search operators."""

import base64
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ionloom.constants import PROTON, RESIDUES, SCALE, WATER, mass_int
from ionloom.functions import naming, sequence
from ionloom.operators import candidates as C
from ionloom.operators import decoys, fdr, features, fragments, loop, xcorr
from ionloom.operators import precursors as P
from ionloom.params import SearchParams, XcorrParams
from ionloom.plans.search import search
from ionloom.session import written
from ionloom.sources import mzml, sinks, tables
from ionloom.streaming import runner


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_charges(spark):
    none = F.lit(None).cast("array<smallint>")
    short = lambda *x: F.array(*map(F.lit, x)).cast("array<smallint>")
    assert one(spark, P.charges(none, none, 6)) == [2, 3, 4, 5, 6]
    assert one(spark, P.charges(short(3), short(2, 3), 6)) == [3, 2, 3]
    assert one(spark, P.charges(none, none, 1)) == []


def test_bounds_truncate(spark):
    m = F.lit(1_000_000_007).cast("long")
    assert one(spark, P.ppm_low(m, 10)) == 999_990_007
    assert one(spark, P.ppm_high(m, 10)) == 1_000_010_007


def test_sequence_functions(spark):
    assert one(spark, sequence.missed_cleavages(F.lit("AKPRKKAARPK"))) == 3
    want = sum(mass_int(RESIDUES[a]) for a in "PEPTIDEK") + mass_int(WATER)
    assert one(spark, sequence.sequence_mass(F.lit("PEPTIDEK"))) == want
    assert one(spark, sequence.mass_partition(F.lit(7).cast("long"), [5, 7, 9])) == 1


def test_names(spark):
    assert one(spark, naming.sanitize_path(F.lit("  a / b\tc\0d "))) == "a_b_c_d"
    assert one(spark, naming.sanitize_word(F.lit("controllerType=0 scan=12ä"))) == "controllerType_0_scan_12ä"
    assert one(spark, naming.fasta_entry(F.lit("PEPTIDEK"), F.lit(1), True)) == ">mdb|T1|T1\nPEPTIDEK\n"
    assert one(spark, naming.fasta_entry(F.lit("A" * 61), F.lit(2), False)) == f">moy|D2|D2\n{'A' * 60}\nA\n"
    mz, charge = naming.parse_precursor(F.lit("500.25_2.psms.tsv"))
    assert (one(spark, mz), one(spark, charge)) == (500.25, 2)
    mz, charge = naming.parse_precursor(F.lit("what.psms.tsv"))
    assert (one(spark, mz), one(spark, charge)) == (-1.0, 0)


def test_fdr_micro(spark):
    df = spark.createDataFrame([(1, 5.0, "mdb"), (2, 4.0, "moy"), (3, 3.0, "mdb"), (4, 2.0, "moy"), (5, None, "mdb")], "i int, xcorr double, protein string")
    want = [0, 1 / 2, 1 / 3, 2 / 4, 2 / 5]
    got = fdr.fdr_global(fdr.mark_targets(df), "xcorr", ["i"], written).orderBy("i").collect()
    assert [r.fdr for r in got] == pytest.approx(want)
    got = fdr.fdr_by(fdr.mark_targets(df).withColumn("g", F.lit(1)), ["g"], "xcorr", ["i"]).orderBy("i").collect()
    assert [r.fdr for r in got] == pytest.approx(want)


def test_features_and_second_mass(spark):
    assert one(spark, features.ratio(F.lit(5), F.lit(20))) == 0.25
    assert one(spark, features.ratio(F.lit(5), F.lit(0))) is None
    assert one(spark, features.second_mass(F.lit(900.0), F.lit(900.0))) is None
    assert one(spark, features.second_mass(F.lit(900.0), F.lit(900.5))) == 900.5
    df = spark.createDataFrame([("a", 1.0, 0), ("b", 2.0, 1), ("c", 1.0, 2)], "n string, xcorr double, seq int")
    assert [r.n for r in features.best_first(df, "seq").collect()] == ["b", "c", "a"]


def test_range_join_equals_nested_loop(spark):
    rng = random.Random(5)
    left = [(i, m := rng.randrange(500, 3000) * SCALE, m - m * 300 // 1_000_000, m + m * 700 // 1_000_000) for i in range(300)]
    left += [(900, None, None, None), (901, 5, 9, 3)]
    right = [(i, rng.randrange(500 * SCALE, 3000 * SCALE)) for i in range(3000)]
    a, b = spark.createDataFrame(left, "scan int, m long, lo long, hi long"), spark.createDataFrame(right, "p int, library_mass long")
    got = {(r.scan, r.p) for r in C.mass_window_join(a, b, C.bin_width(3000 * SCALE, 300, 700)).collect()}
    assert got == {(s, p) for s, m, lo, hi in left if m for p, x in right if lo <= x <= hi}


def test_size_metric_and_needed(spark):
    df = spark.createDataFrame([(1, "AAA", True), (1, "CCCC", True), (1, "D", False)], "scan int, peptide string, is_target boolean")
    r = C.size_metric(df.where("is_target"), ["scan"]).first()
    assert (r.size, r.len) == (28, 2)
    assert C.needed_decoys(df, ["scan"], 3).first().needed == 6


def test_decoys_are_seeded_and_valid():
    target = 1_200 * SCALE
    lo, hi = target - target // 5000, target + target // 5000
    got = [decoys.decoy(target, lo, hi, random.Random(s)) for s in range(20)]
    assert got == [decoys.decoy(target, lo, hi, random.Random(s)) for s in range(20)]
    for s in filter(None, got):
        assert decoys.acceptable(s, sum(mass_int(RESIDUES[a]) for a in s) + mass_int(WATER), lo, hi, decoys.DecoyRules())
    assert any(got)


def test_loop_against_plain_python():
    x = np.random.default_rng(3).normal(size=(40, 3))
    k, lam = 7, 3
    d = [[math.dist(a, b) for b in x] for a in x]
    near = [sorted((j for j in range(40) if j != i), key=lambda j: d[i][j])[:k] for i in range(40)]
    pd = [lam * math.sqrt(sum(d[i][j] ** 2 for j in near[i]) / k) for i in range(40)]
    plof = [pd[i] / (sum(pd[j] for j in near[i]) / k) - 1 for i in range(40)]
    n = lam * math.sqrt(sum(v * v for v in plof) / 40)
    want = [max(0.0, math.erf(v / (n * math.sqrt(2)))) for v in plof]
    assert loop.loop_scores(x, k, lam)[2] == pytest.approx(want)
    assert loop.loop_scores(x[:1])[2].tolist() == [0.0]
    assert loop.loop_scores(np.ones((5, 3)))[2].tolist() == [0.0] * 5


def dense_xcorr(peaks, ions, p):
    bin_of = lambda mz: math.floor(mz / p.bin_size + 1 - p.bin_offset)
    top = {}
    for mz, i in peaks:
        top[bin_of(mz)] = max(top.get(bin_of(mz), 0), math.sqrt(i))
    last = max(top)
    y = np.zeros(last + 400)
    for b, h in top.items():
        best = max(v for c, v in top.items() if c * p.windows // (last + 1) == b * p.windows // (last + 1))
        y[b] = h * 50 / best if best else 0
    fast = np.array([y[b] - (y[max(0, b - p.background) : b + p.background + 1].sum() - y[b]) / (2 * p.background) for b in range(len(y))])
    score = 0
    for mz in ions:
        b = bin_of(mz)
        score += fast[b] + (0.5 * (fast[b - 1] + fast[b + 1]) if p.use_flanking_peaks else 0)
    return score * 0.005, len(ions), sum(y[bin_of(mz)] > 0 for mz in ions)


def test_relational_xcorr_equals_dense(spark):
    p = XcorrParams(bin_size=1.0005)
    rng = random.Random(2)
    peaks = [(s, rng.uniform(100, 900), rng.uniform(0, 100)) for s in (1, 2) for _ in range(60)]
    df = spark.createDataFrame(peaks, "scan int, mz double, intensity double")
    heights = xcorr.normalised(xcorr.binned(df, p), p)
    ions = fragments.ions(spark.createDataFrame([("PEPTIDEK",), ("SAMPLER",)], "sequence string").withColumn("peptide", F.col("sequence")), "peptide", ("B", "Y"), 1)
    by = {}
    for r in ions.collect():
        by.setdefault(r.peptide, []).append(r.mz)
    assert sorted(by["PEPTIDEK"])[0] == pytest.approx(RESIDUES["P"] + PROTON, abs=1e-6)
    bins = ions.select("peptide", xcorr.bin_of(F.col("mz"), p).alias("bin")).join(df.select("scan").distinct())
    for r in xcorr.scores(heights, bins, p).collect():
        want = dense_xcorr([(m, i) for s, m, i in peaks if s == r.scan], by[r.peptide], p)
        assert (r.xcorr, r.ions_total, r.ions_matched) == (pytest.approx(want[0]), want[1], want[2])


def mzml_file(path):
    arr = lambda v, acc: f'<binaryDataArray><cvParam accession="MS:1000523"/><cvParam accession="MS:1000574"/><cvParam accession="{acc}"/><binary>{base64.b64encode(zlib.compress(np.array(v, "<f8").tobytes())).decode()}</binary></binaryDataArray>'
    mass = sum(RESIDUES[a] for a in "PEPTIDEK") + WATER
    mz = (mass + 2 * PROTON) / 2
    peaks = [RESIDUES["P"] + PROTON, RESIDUES["P"] + RESIDUES["E"] + PROTON, RESIDUES["K"] + WATER + PROTON, 400.0]
    spec = lambda i, level, pre: f'<spectrum index="{i}" id="scan={i}"><cvParam accession="MS:1000511" value="{level}"/>{pre}<binaryDataArrayList>{arr(peaks, "MS:1000514")}{arr([50, 80, 90, 10], "MS:1000515")}</binaryDataArrayList></spectrum>'
    ion = lambda z: f'<precursorList><precursor><selectedIonList><selectedIon><cvParam accession="MS:1000744" value="{mz!r}"/>{z}</selectedIon></selectedIonList></precursor></precursorList>'
    body = spec(1, 1, "") + spec(2, 2, ion('<cvParam accession="MS:1000041" value="2"/>')) + spec(3, 2, ion(""))
    path.write_text(f'<?xml version="1.0"?><mzML xmlns="http://psi.hupo.org/ms/mzml"><run id="r"><spectrumList>{body}</spectrumList></run></mzML>')


def test_search_from_mzml_to_parquet(spark, tmp_path):
    mzml_file(tmp_path / "run 1.mzML")
    spectra = mzml.read_spectra(spark, str(tmp_path / "*.mzML"), "u1")
    assert [(r.spectrum_id, r.ms_level, len(r.mz)) for r in spectra.orderBy("spectrum_id").collect()] == [("scan=1", 1, 4), ("scan=2", 2, 4), ("scan=3", 2, 4)]
    index = mzml.spectrum_index(spark, str(tmp_path / "*.mzML")).collect()
    text = (tmp_path / "run 1.mzML").read_bytes()
    assert len(index) == 3 and all(text[r.offset :].startswith(b"<spectrum") for r in index)
    got = mzml.extract_spectrum(spark, str(tmp_path / "*.mzML"), "scan=2").first().mzml
    assert [s["spectrum_id"] for s in mzml.spectra_of(got.encode())] == ["scan=2"]
    peptides = spark.createDataFrame([("PEPTIDEK",), ("PEPTIDKE",), ("SAMPLER",)], "sequence string")
    lib = peptides.select(sequence.sequence_mass(F.col("sequence")).alias("mass"), "sequence", F.lit(0).cast("short").alias("missed_cleavages"))
    tables.write_library(lib, str(tmp_path / "lib"), SCALE)
    library = tables.read_library(spark, str(tmp_path / "lib"), max_mass=5000 * SCALE)
    found = search(spectra, library, SearchParams(decoys_per_peptide=1, lower_mass_tolerance_ppm=200, upper_mass_tolerance_ppm=200), 10_000 * SCALE, seed=4)
    sinks.write_psms(found, str(tmp_path / "psms"))
    sinks.write_psms(found, str(tmp_path / "psms"))  # a repeated write changes nothing
    back = spark.read.parquet(str(tmp_path / "psms"))
    rows = back.where("is_target").orderBy("spectrum_id", "peptide").collect()
    assert [(r.spectrum_id, r.charge, r.peptide) for r in rows] == [("scan=2", 2, "PEPTIDEK"), ("scan=2", 2, "PEPTIDKE"), ("scan=3", 2, "PEPTIDEK"), ("scan=3", 2, "PEPTIDKE")]
    assert rows[0].ions_matched == 3 and rows[0].xcorr > rows[1].xcorr
    assert all(0 <= r.loop_score <= 1 for r in back.collect())
    assert tables.run_listing(back).first().spectra == 2


def test_stream_of_spectra_equals_batch(spark, tmp_path):
    mzml_file(tmp_path / "a.mzML")
    spectra = mzml.read_spectra(spark, str(tmp_path / "a.mzML"), "u")
    spectra.write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    q = runner.run_stream(runner.watch_spectra(spark, str(tmp_path / "in")), lambda df: P.explode_precursors(P.ms2_spectra(df)), lambda df, n: df.write.mode("overwrite").parquet(f"{out}/{n}"), str(tmp_path / "cp"))
    q.awaitTermination()
    key = lambda df: sorted((r.spectrum_id, r.precursor_no, r.charge) for r in df.collect())
    assert key(spark.read.option("recursiveFileLookup", "true").parquet(out)) == key(P.explode_precursors(P.ms2_spectra(spectra)))


def test_tables_and_sinks(spark, tmp_path):
    (tmp_path / "ptm.csv").write_text("amino_acid,mass_delta,mod_type,position\nC,57.02,Static,Anywhere\nM,15.99,Variable,Anywhere\n")
    assert tables.read_ptms(spark, str(tmp_path / "ptm.csv")).count() == 2
    (tmp_path / "bad.csv").write_text("amino_acid,mass_delta,mod_type,position\nC,57.02,Static,Anywhere\nC,5.0,Static,Anywhere\n")
    with pytest.raises(ValueError):
        tables.read_ptms(spark, str(tmp_path / "bad.csv"))
    d = spark.createDataFrame([(1, "AK", 0), (1, "AK", 0), (2, "CK", 0)], "mass long, sequence string, missed_cleavages short")
    sinks.append_decoys(d, str(tmp_path / "cache"))
    sinks.append_decoys(d, str(tmp_path / "cache"))
    assert sinks.read_decoys(spark, str(tmp_path / "cache")).count() == 2
    e = spark.createDataFrame([("u", None, None, None, "x"), ("u", "r", "s", 5.0, "y")], "uuid string, ms_run string, spectrum_id string, precursor double, error string")
    sinks.append_errors(e, str(tmp_path / "err"))
    assert {r.level for r in spark.read.json(str(tmp_path / "err")).collect()} == {"search", "precursor"}


def test_flags_expire(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:00:08"), ("b", "2024-01-01 00:00:01")], "key string, at string").withColumn("at", F.to_timestamp("at"))
    assert [r.key for r in runner.live_flags(df, "5 seconds", F.to_timestamp(F.lit("2024-01-01 00:00:10"))).collect()] == ["a"]


def test_params_round_trip():
    p = SearchParams(max_charge=4, xcorr=XcorrParams(bin_size=0.5, ions=("B",)))
    assert SearchParams.from_toml(p.to_toml()) == p
    with pytest.raises(ValueError):
        SearchParams.from_toml("[search_parameters.xcorr]\nnope = 1\n")


def test_library_bounds_prune_folders(spark, tmp_path):
    from ionloom.sources import tables

    lib = spark.range(1000).select((F.col("id") * 1000).alias("mass"), F.col("id").cast("string").alias("sequence"), F.lit(0).cast("short").alias("missed_cleavages"))
    tables.write_library(lib, str(tmp_path / "lib"), 100_000)
    got = tables.read_library(spark, str(tmp_path / "lib"), max_mass=350_000, min_mass=250_000)
    assert sorted(r.mass for r in got.collect()) == list(range(250_000, 350_001, 1000))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "partition" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(got.inputFiles()) and {f.split("partition=")[1].split("/")[0] for f in [r[0] for r in got.select(F.input_file_name()).distinct().collect()]} == {"2", "3"}
    lib.withColumn("partition", F.lit(0).cast("long")).write.parquet(str(tmp_path / "plain"))
    assert tables.read_library(spark, str(tmp_path / "plain"), max_mass=5000, min_mass=3000).count() == 3


def test_bad_spectra_become_error_rows(spark, tmp_path):
    from ionloom.plans.search import spectrum_errors
    from ionloom.sources import mzml, sinks

    def one(i, mz, peaks="AAAAAAAA8D8="):
        arrays = "".join(f'<binaryDataArray><cvParam accession="{a}"/><cvParam accession="MS:1000523"/><binary>{peaks}</binary></binaryDataArray>' for a in (mzml.MZ_ARRAY, mzml.INTENSITY_ARRAY))
        return f'<spectrum id="s{i}"><cvParam accession="MS:1000511" value="2"/><selectedIon><cvParam accession="MS:1000744" value="{mz}"/><cvParam accession="MS:1000041" value="x"/></selectedIon>{arrays}</spectrum>'

    (tmp_path / "a.mzML").write_text("<mzML>" + one(0, "500.5") + one(1, "bad") + one(2, "-3") + one(3, "400", "%%%") + "</mzML>")
    spectra = mzml.read_spectra(spark, str(tmp_path / "a.mzML"), "u")
    found = {(r.spectrum_id, r.error) for r in spectrum_errors(spectra).collect()}
    assert found == {("s1", "precursor without m/z"), ("s2", "precursor m/z is not positive"), ("s3", "no peaks")}
    assert all(r.precursors[0].charge is None for r in spectra.collect())
    sinks.append_errors(spectrum_errors(spectra), str(tmp_path / "errors"))
    assert {(r.level, r.spectrum_id) for r in spark.read.json(str(tmp_path / "errors")).collect()} == {("precursor", "s1"), ("precursor", "s2"), ("spectrum", "s3")}
    assert spectrum_errors(spectra.limit(0)).count() == 0
