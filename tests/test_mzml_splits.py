"""mzML files in byte ranges, as a stream, cut off, packed and with a head."""

import base64
import gzip
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ionloom import cli
from ionloom.constants import SCALE
from ionloom.functions import sequence
from ionloom.params import SearchParams
from ionloom.sources import mzml, tables
from tests.test_operators import mzml_file

HEAD = '<?xml version="1.0" encoding="utf-8"?>\n<indexedmzML xmlns="http://psi.hupo.org/ms/mzml"><mzML version="1.1.0"><cvList count="1"><cv id="MS"/></cvList><referenceableParamGroupList count="1"><referenceableParamGroup id="g"/></referenceableParamGroupList><run id="r"><spectrumList count="N" defaultDataProcessingRef="é">\n'
TAIL = '</spectrumList></run></mzML><indexList count="1"><index name="spectrum"><offset idRef="scan=1">9</offset></index></indexList></indexedmzML>\n'


def document(n, seed=5):
    rng = random.Random(seed)
    arr = lambda v, acc: f'<binaryDataArray><cvParam accession="MS:1000523"/><cvParam accession="{acc}"/><binary>{base64.b64encode(np.array(v, "<f8").tobytes()).decode()}</binary></binaryDataArray>'
    body = ""
    for i in range(n):
        k = rng.choice([0, 1, 3, 40])
        body += f'<spectrum index="{i}" id="scan={i} a&amp;b" title="ü">\n<cvParam accession="MS:1000511" name="ms level" value="{1 + i % 2}"/>{arr(range(k), mzml.MZ_ARRAY)}{arr([i] * k, mzml.INTENSITY_ARRAY)}</spectrum>\n'
    return HEAD.replace('"N"', f'"{n}"') + body + TAIL


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in names}
    yield lambda n: [spark.conf.set(k, v) for k, v in zip(names, (str(n), "0"), strict=True)]
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [700, 1009, 5000, 1 << 27])
def test_splits_hold_every_spectrum_once(spark, tmp_path, small_splits, size):
    texts = {f"run {r}": document(120, r) for r in range(2)}
    for name, text in texts.items():
        (tmp_path / f"{name}.mzML").write_text(text, encoding="utf-8")
    small_splits(size)
    path = str(tmp_path / "*.mzML")
    got = mzml.read_spectra(spark, path, "u")
    assert size > 5000 or got.rdd.getNumPartitions() > 10
    found = sorted((r.ms_run, r.spectrum_id, r.ms_level, tuple(r.mz), tuple(r.intensity)) for r in got.collect())
    want = sorted((n, s["spectrum_id"], s["ms_level"], tuple(s["mz"]), tuple(s["intensity"])) for n, t in texts.items() for s in mzml.spectra_of(t.encode()))
    assert found == want and len({x[:2] for x in found}) == 240 and found[0][1] == "scan=0 a&b"
    index = mzml.spectrum_index(spark, path).collect()
    assert len(index) == 240
    for r in index:
        assert texts[r.ms_run].encode()[r.offset :].startswith(f'<spectrum index="{r.spectrum_id[5:].split(" ")[0]}"'.encode())
    assert mzml.spectrum_index(spark, path, without_ms2=True).count() == 120
    one = {r.ms_run: r.mzml for r in mzml.extract_spectrum(spark, path, "scan=7 a&b").collect()}
    assert set(one) == set(texts)
    for r, text in one.items():
        assert '<cv id="MS"/>' in text and "referenceableParamGroup" in text and '<spectrumList count="1"' in text
        want = [s for s in mzml.spectra_of(texts[r].encode()) if s["spectrum_id"] == "scan=7 a&b"]
        assert list(mzml.spectra_of(text.encode())) == want
    assert mzml.extract_spectrum(spark, path, "scan=999").count() == 0


def test_cut_off_packed_and_empty_files(spark, tmp_path):
    from ionloom.plans.search import spectrum_errors

    text = document(6).encode()
    cut = text.rindex(b"</spectrum>") - 30
    (tmp_path / "cut.mzML").write_bytes(text[:cut])
    (tmp_path / "none.mzML").write_bytes(b"")
    (tmp_path / "no_spectra.mzML").write_text(HEAD + TAIL)
    (tmp_path / "packed.mzML.gz").write_bytes(gzip.compress(text))
    got = mzml.read_spectra(spark, str(tmp_path), "u")
    assert {(r.ms_run, r.n) for r in got.groupBy("ms_run").agg(F.count("*").alias("n")).collect()} == {("cut", 6), ("packed", 6)}
    assert ("cut", "scan=5 a&b", "no peaks") in {(r.ms_run, r.spectrum_id, r.error) for r in spectrum_errors(got).collect()}


def test_search_of_files_that_arrive(spark, tmp_path):
    peptides = spark.createDataFrame([("PEPTIDEK",), ("SAMPLER",)], "sequence string")
    lib = peptides.select(sequence.sequence_mass(F.col("sequence")).alias("mass"), "sequence", F.lit(0).cast("short").alias("missed_cleavages"))
    tables.write_library(lib, str(tmp_path / "lib"), SCALE)
    (tmp_path / "p.toml").write_text(SearchParams(decoys_per_peptide=0, lower_mass_tolerance_ppm=200, upper_mass_tolerance_ppm=200).to_toml())
    (tmp_path / "in").mkdir()
    call = ["remote-run", str(tmp_path / "in"), str(tmp_path / "lib"), str(tmp_path / "out"), "--params", str(tmp_path / "p.toml"), "--format", "mzml"]
    with pytest.raises(SystemExit):
        cli.main(call)  # a stream that is taken up again needs the name of its search
    for name in ("a", "b"):
        mzml_file(tmp_path / "in" / f"{name}.mzML")
        assert cli.main([*call, "--uuid", "s"]) == 0
    found = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.batch, r.uuid, r.ms_run, r.spectrum_id) for r in found.collect()} == {(b, "s", r, f"scan={i}") for b, r in ((0, "a"), (1, "b")) for i in (2, 3)}
