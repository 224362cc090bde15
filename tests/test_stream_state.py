"""A stream's side tables after a replay, live progress, expiring flags over a restart, and reads at places of an index."""

import gzip
import time

import pytest
from pyspark.sql import functions as F

from ionloom import cli
from ionloom.constants import SCALE
from ionloom.params import SearchParams
from ionloom.plans import search as S
from ionloom.sources import mzml, tables
from ionloom.streaming import flags, runner
from tests.test_modified_search import library_of
from tests.test_mzml_splits import document
from tests.test_operators import mzml_file


def test_a_replayed_batch_leaves_everything_once(spark, tmp_path):
    mzml_file(tmp_path / "a.mzML")
    good = mzml.read_spectra(spark, str(tmp_path / "a.mzML"), "u")
    bad = good.where("spectrum_id = 'scan=3'").withColumns({"mz": F.array().cast("array<double>"), "ms_run": F.lit("bad")})
    library = library_of(spark, "PEPTIDEK", "PEPTIDKE")
    p = SearchParams(decoys_per_peptide=2, lower_mass_tolerance_ppm=200, upper_mass_tolerance_ppm=200, keep_fasta_files=True)
    out, cache = str(tmp_path / "out"), str(tmp_path / "cache")
    batches = [good.where("spectrum_id <> 'scan=3'"), good.where("spectrum_id = 'scan=3'").unionAll(bad), good.where("spectrum_id = 'scan=2'")]
    listed = lambda kind, side: sorted(map(str, (spark.read.text if kind == "text" else spark.read.json if kind == "json" else spark.read.parquet)(out + side).drop("ms", "batch").collect()))
    seen = []
    for order in ((0, 1, 2), (1,)):  # the second pass repeats a batch, as a restart does
        for n in order:
            cli.store(spark, S.find(batches[n], library, p, 10_000 * SCALE), out, p, "u", n, cache)
        seen.append([listed("parquet", ""), listed("text", ".candidates"), listed("parquet", ".metrics"), listed("json", ".errors"), listed("parquet", ".finished"), listed("parquet", ".times")])
        assert {r.uuid: r.finished for r in runner.finished_counts(spark, out + ".finished").collect()} == {"u": 3}
    assert seen[0] == seen[1]
    assert len(seen[0][3]) == 1 and "no peaks" in seen[0][3][0] and all(seen[0])


def test_stream_of_searches_tells_its_progress(spark, tmp_path):
    mzml_file(tmp_path / "a.mzML")
    spectra = mzml.read_spectra(spark, str(tmp_path / "a.mzML"), "u")
    tables.write_library(library_of(spark, "PEPTIDEK"), str(tmp_path / "lib"), SCALE)
    (tmp_path / "p.toml").write_text(SearchParams(lower_mass_tolerance_ppm=200, upper_mass_tolerance_ppm=200).to_toml())
    told = []
    listener = runner.Progress(told.append)
    spark.streams.addListener(listener)
    try:
        for n, scan in enumerate(("scan=2", "scan=3")):
            spectra.where(F.col("spectrum_id") == scan).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            assert cli.main(["remote-run", str(tmp_path / "in"), str(tmp_path / "lib"), str(tmp_path / "out"), "--params", str(tmp_path / "p.toml")]) == 0
            assert {r.uuid: r.finished for r in runner.finished_counts(spark, str(tmp_path / "out.finished")).collect()} == {"u": n + 1}
        for _ in range(50):
            if len({r["batch"] for r in told}) == 2 and len(listener.ended) == 2:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert {(r["batch"], r["rows"]) for r in told if r["rows"]} == {(0, 1), (1, 1)} and list(listener.ended) == [None, None]


def test_flags_expire_and_are_renewed_over_a_restart(spark, tmp_path):
    folder, idle = str(tmp_path / "in"), 24

    def run(*events):
        """A query of its own, which takes up the state where the last one left it."""
        began = time.time()
        spark.createDataFrame(list(events), flags.EVENTS).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(flags.EVENTS).parquet(folder)
        got = []
        q = flags.start(stream, idle * 1000, lambda df, n: got.extend(map(tuple, df.collect())), str(tmp_path / "checkpoint"))
        assert q.awaitTermination(60)
        return {x[:2]: x[2] for x in got}, began, time.time()

    run(("z", "set"))  # the first query of a session is slow
    first, _, last_of_a = run(("a", "set"), ("b", "set"), ("c", "set"), (None, "set"), ("a", "other"))
    assert first == {("a", "set"): True, ("b", "set"): True, ("c", "set"): True}
    time.sleep(9)
    second, renewed, _ = run(("b", "read"), ("c", "clear"), ("d", "read"))
    assert second == {("b", "read"): True, ("c", "clear"): False, ("d", "read"): False}
    time.sleep(max(0, last_of_a + idle + 0.5 - time.time()))
    assert time.time() < renewed + idle
    third, _, _ = run(("a", "read"), ("b", "read"), ("c", "read"), ("d", "read"))
    assert third == {("a", "read"): False, ("b", "read"): True, ("c", "read"): False, ("d", "read"): False}


@pytest.mark.parametrize("packed", [False, True])
def test_reads_at_places(spark, tmp_path, packed):
    texts = {f"run {r}": document(3000, r).encode() for r in range(2)}
    texts["run 1"] = b"\xef\xbb\xbf" + texts["run 1"]
    for name, text in texts.items():
        (tmp_path / f"{name}.mzML{'.gz' if packed else ''}").write_bytes(gzip.compress(text) if packed else text)
    path = str(tmp_path / "run*")
    mzml.write_places(mzml.spectrum_places(spark, path), str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    assert index.count() == 6000
    want = {(r.ms_run, r.spectrum_id): (r.ms_level, r.mz, r.intensity) for r in mzml.read_spectra(spark, path, "u").collect()}
    ids = ["scan=0 a&b", "scan=1717 a&b", "scan=2999 a&b"]
    some = mzml.read_places(index.where(F.col("spectrum_id").isin(ids)), "u").collect()
    assert len(some) == 6 and all((r.ms_level, r.mz, r.intensity) == want[r.ms_run, r.spectrum_id] for r in some)
    assert mzml.read_places(index, "u").count() == 6000
    size = min(map(len, texts.values()))
    one = mzml.extract_places(index.where("spectrum_id = 'scan=1717 a&b'")).collect()
    assert len(one) == 2
    for r in one:
        assert '<cv id="MS"/>' in r.mzml and '<spectrumList count="1"' in r.mzml
        assert [(s["ms_level"], s["mz"], s["intensity"]) for s in mzml.spectra_of(r.mzml.encode())] == [want[r.ms_run, "scan=1717 a&b"]]
        if not packed:
            assert r.bytes_read < 4000 < size / 100
    if not packed:
        assert sum(r.bytes_read for r in some) < 12_000
        (tmp_path / "run 0.mzML").write_bytes(b"x" * size)
        assert mzml.read_places(index.where(F.col("spectrum_id").isin(ids)), "u").count() == 3


def test_extract_by_index_from_the_command_line(spark, tmp_path, capsys):
    (tmp_path / "a.mzML").write_text(document(50), encoding="utf-8")
    files, index = str(tmp_path / "a.mzML"), str(tmp_path / "index")
    assert cli.main(["index-spectrum-file", files, index, "--places"]) == 0
    assert cli.main(["extract-spectrum", files, "scan=7 a&b"]) == 0
    whole = capsys.readouterr().out
    assert cli.main(["extract-spectrum", files, "scan=7 a&b", "--index", index]) == 0
    assert list(mzml.spectra_of(capsys.readouterr().out.encode())) == list(mzml.spectra_of(whole.encode()))
