"""Libraries by mass quantiles with pruned folders, and the filter in front of the lookup of targets."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ionloom import cli
from ionloom.constants import SCALE
from ionloom.operators import membership as M
from ionloom.params import SearchParams
from ionloom.plans import search as S
from ionloom.sources import layout as L
from ionloom.sources import tables
from tests.test_modified_search import library_of, spectra_of_mass, weight
from tests.test_operators import mzml_file


def words(n, seed):
    r = random.Random(seed)
    return ["".join(r.choices("ACDEFGHIKLMNPQRSTVWY", k=r.randint(6, 12))) for _ in range(n)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("library") / "lib")
    rows = library_of(spark, *sorted(set(words(4000, 1))))
    return path, rows, L.write_laid_out(rows, path, 16)


def test_folders_are_about_equal_and_whole(spark, stored):
    path, rows, laid = stored
    back = tables.read_library(spark, path)
    sizes = [r["count"] for r in back.groupBy("partition").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1.1 * min(sizes) and sum(sizes) == laid.peptides == rows.count()
    assert all(r.partition == sum(x < r.mass for x in laid.limits) for r in back.collect())
    assert {r.sequence for r in back.collect()} == {r.sequence for r in rows.collect()}


def test_odd_masses(spark):
    one = spark.createDataFrame([(5,)] * 9 + [(None,)], "mass long")
    assert L.quantile_limits(one, 4) == [5] and L.quantile_limits(one.limit(0), 4) == []
    assert {r.p for r in one.select(L.partition_of(F.col("mass"), [5]).alias("p")).collect()} == {0, None}
    assert {r.p for r in one.select(L.partition_of(F.col("mass"), []).alias("p")).collect()} == {0, None}
    with pytest.raises(ValueError):
        L.quantile_limits(one, 0)


def test_search_opens_only_the_folders_that_windows_meet(spark, stored):
    path, rows, laid = stored
    target = rows.orderBy("mass").offset(1700).first()
    p = SearchParams(decoys_per_peptide=0, lower_mass_tolerance_ppm=20, upper_mass_tolerance_ppm=20)
    library, precursors = tables.read_library(spark, path), S.precursor_rows(spectra_of_mass(spark, target.mass), p)
    windows = precursors.select("lo", "hi")
    cut = L.touched(library, windows, laid.limits)
    plan = cut._jdf.queryExecution().explainString(cut.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert re.search(r"PartitionFilters: .*dynamicpruning", plan)
    assert cut.select("partition").distinct().count() == 1
    got = {(r.scan, r.peptide) for r in S.search_space(precursors, library, p, 10_000 * SCALE, layout=laid).candidates.collect()}
    want = {(r.scan, r.peptide) for r in S.search_space(precursors, library, p, 10_000 * SCALE).candidates.collect()}
    assert got == want and target.sequence in {x for _, x in got}
    between = L.between(library, laid.limits, target.mass - 10, target.mass + 10)
    assert target.sequence in {r.sequence for r in between.collect()} and all(abs(r.mass - target.mass) <= 10 for r in between.collect())


def test_decoys_of_a_laid_out_library_are_no_targets(spark, stored):
    path, rows, laid = stored
    target = rows.orderBy("mass").offset(2500).first()
    p = SearchParams(decoys_per_peptide=3, lower_mass_tolerance_ppm=50, upper_mass_tolerance_ppm=50)
    precursors = S.precursor_rows(spectra_of_mass(spark, target.mass), p)
    cached = spark.createDataFrame([(target.sequence,), (target.sequence[::-1],)], "sequence string")
    got = S.search_space(precursors, tables.read_library(spark, path), p, 10_000 * SCALE, cached=cached, layout=laid).candidates.collect()
    plain = S.search_space(precursors, tables.read_library(spark, path), p, 10_000 * SCALE, cached=cached).candidates.collect()
    known = {r.sequence for r in rows.collect()}
    assert all((r.peptide in known) == r.is_target for r in got) and any(not r.is_target for r in got)
    assert sorted((r.scan, r.peptide, r.is_target) for r in got) == sorted((r.scan, r.peptide, r.is_target) for r in plain)


def test_filter_finds_all_targets_and_keeps_others_from_the_lookup(spark):
    targets = spark.createDataFrame([(w,) for w in words(5000, 2)] + [(None,)], "sequence string")
    others = words(5000, 3)
    rows = spark.createDataFrame([(w, i) for i, w in enumerate(others + words(300, 2) + others[:50])] + [(None, -1)], "sequence string, block int")
    known = M.build_filter(targets)
    marked = M.probed(rows, known)
    held = {r.sequence for r in targets.collect()}
    assert all(r.maybe_target for r in marked.collect() if r.sequence is not None and r.sequence in held)
    # what the filter keeps from the shuffle: all but about one in a hundred rows that are no targets
    assert marked.where("maybe_target").count() <= 301 + 0.02 * len(others)
    key = lambda df: sorted((str(r.sequence), r.block) for r in df.collect())
    got = M.without_known(rows, targets, known)
    assert key(got) == key(rows.join(targets, "sequence", "left_anti")) and got.columns == rows.columns
    assert key(M.only_known(rows, targets, known)) == key(rows.join(targets, "sequence", "left_semi"))


def test_filter_at_the_edges(spark, monkeypatch):
    rows = spark.createDataFrame([("ACDK",), ("ACDK",), ("",), (None,)], "sequence string")
    none = rows.limit(0)
    known = M.build_filter(none)
    assert M.without_known(rows, none, known).count() == 4 and M.only_known(rows, none, known).count() == 0
    # a filter too full to rule anything out changes no result
    full = M.build_filter(spark.createDataFrame([(w,) for w in words(3000, 4)], "sequence string"), blocks=1)
    assert M.without_known(rows, rows.where("sequence = ''"), full).count() in (3, 4)
    both = M.build_filter(rows)
    assert M.without_known(rows, rows, both).collect() == [(None,)]
    monkeypatch.setattr(M, "MAX_BYTES", 0)
    assert M.without_known(rows, rows, both).collect() == [(None,)] and M.only_known(rows, rows, both).count() == 3


def test_parts_merge(spark):
    """A filter is the same whichever way its rows are spread."""
    rows = spark.createDataFrame([(w,) for w in words(1000, 5)], "sequence string")
    a, b = (M.build_filter(rows.repartition(n), blocks=3).rows.orderBy("block").collect() for n in (1, 7))
    assert a == b and len(a) == 3


def test_commands_with_a_laid_out_library(spark, tmp_path, capsys):
    (tmp_path / "seqs").write_text("PEPTIDEK\nSAMPLER\nSAMPLER\n")
    assert cli.main(["database-build", str(tmp_path / "seqs"), str(tmp_path / "lib"), "--partitions", "2"]) == 0
    laid = L.read_layout(spark, str(tmp_path / "lib"))
    assert laid.peptides == 2 and len(laid.limits) == 1 and L.read_layout(spark, str(tmp_path)) is None
    mass = weight(spark, "PEPTIDEK")
    assert cli.main(["search-space-build", str(tmp_path / "lib"), str(mass), str(tmp_path / "fasta")]) == 0
    assert "PEPTIDEK" in "".join(r.value for r in spark.read.text(str(tmp_path / "fasta")).collect())
    mzml_file(tmp_path / "a.mzML")
    (tmp_path / "p.toml").write_text(SearchParams(decoys_per_peptide=1, lower_mass_tolerance_ppm=200, upper_mass_tolerance_ppm=200).to_toml())
    tables.write_library(tables.read_library(spark, str(tmp_path / "lib")).select("mass", "sequence", "missed_cleavages"), str(tmp_path / "bins"), SCALE)
    found = []
    for lib in ("lib", "bins"):
        out = str(tmp_path / f"out-{lib}")
        assert cli.main(["local-run", str(tmp_path / "a.mzML"), str(tmp_path / lib), out, "--params", str(tmp_path / "p.toml"), "--uuid", "u"]) == 0
        found.append(sorted((r.spectrum_id, r.peptide, r.is_target, r.xcorr) for r in spark.read.parquet(out).collect()))
    assert found[0] == found[1] and found[0]
