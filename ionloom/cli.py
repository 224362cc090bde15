"""Command line: ``python -m ionloom.cli COMMAND``."""

from __future__ import annotations

import argparse
from uuid import uuid4

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ionloom import constants
from ionloom.functions.sequence import missed_cleavages, sequence_mass
from ionloom.operators import candidates as C
from ionloom.operators import ptm, variable
from ionloom.operators.precursors import with_bounds
from ionloom.params import SearchParams
from ionloom.plans.search import PARAMS, SCAN, Found, find
from ionloom.session import session
from ionloom.sources import layout, mzml, sinks, tables
from ionloom.streaming import runner

VERSION = "0.1.0"


def _params(path: str | None) -> SearchParams:
    if not path:
        return SearchParams()
    with open(path) as f:
        return SearchParams.from_toml(f.read())


def store(spark: SparkSession, found: Found, out: str, sp: SearchParams, name: str, batch: int | None = None, decoys: str | None = None) -> int:
    """Everything that a search leaves, from tables written once; a repeated run or batch replaces what it left before.

    Matches and candidates lie by search and run.  Errors, metrics, times and searched spectra lie by batch, that of a search which is no stream being
    its name.  New decoys join the known ones at ``decoys``.  Returns the number of matches.
    """
    of = name if batch is None else batch
    matches, seen = runner.observed(found.matches, f"matches {of}")
    sinks.write_psms(matches, out, batch=batch)
    space = found.space.candidates.join(found.rows.select("scan", *SCAN), "scan")
    sizes = C.size_metric(space, SCAN)
    sinks.replace_batch(sinks.metrics_long(sizes, SCAN, {"size": F.col("size"), "len": F.col("len")}), out + ".metrics", of)
    if sp.keep_fasta_files:
        sinks.write_candidates(space, out + ".candidates", batch)
    sinks.write_errors(found.errors, out + ".errors", of)
    if decoys and found.space.new_decoys is not None:
        sinks.append_decoys(found.space.new_decoys, decoys)
    sinks.replace_batch(found.rows.select("uuid", "ms_run", "spectrum_id").distinct(), out + ".finished", of)
    times = spark.createDataFrame([(k, v * 1000) for k, v in found.seconds.items()], "stage string, ms double")
    sinks.replace_batch(times, out + ".times", of)
    found.discard()
    return seen.get["rows"]


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ionloom")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("version")
    sub.add_parser("config")
    x = sub.add_parser("database-build", help="peptide table from a list of sequences")
    x.add_argument("sequences")
    x.add_argument("out")
    x.add_argument("--bin-dalton", type=float, default=1.0)
    x.add_argument("--partitions", type=int, help="folders by quantiles of the masses instead, with a configuration row and a filter of the sequences")
    x = sub.add_parser("search-space-build", help="FASTA of the targets in a mass window")
    x.add_argument("library")
    x.add_argument("mass", type=int, help="integer mass")
    x.add_argument("out")
    x.add_argument("--params")
    x = sub.add_parser("index-spectrum-file")
    x.add_argument("mzml")
    x.add_argument("out")
    x.add_argument("--without-ms2", action="store_true")
    x.add_argument("--places", action="store_true", help="Parquet with offset and length of each spectrum, for extract-spectrum --index")
    x = sub.add_parser("extract-spectrum")
    x.add_argument("mzml")
    x.add_argument("spectrum_id")
    x.add_argument("--index", help="index of the files with --places: only the spectrum is read")
    for name in ("local-run", "remote-run"):
        x = sub.add_parser(name, help="search mzML files" if name == "local-run" else "search spectra as they arrive in a folder")
        x.add_argument("spectra")
        x.add_argument("library")
        x.add_argument("out")
        x.add_argument("--uuid", help="name of the search; a new one by default")
        x.add_argument("--ptms", help="CSV file of static and variable modifications")
        x.add_argument("--decoys", help="known decoys, as append_decoys writes them; new ones are added")
        x.add_argument("--params")
        x.add_argument("--search-params", help="Parquet with parameters of single searches by uuid and version; a stream reads it for every batch")
        x.add_argument("--max-dalton", type=int, default=10_000)
        if name == "remote-run":
            x.add_argument("--format", choices=("parquet", "mzml"), default="parquet", help="files of the folder; mzml needs --uuid")
            x.add_argument("--follow", action="store_true", help="keep running and search files as they arrive, instead of ending when all are searched")
    x = sub.add_parser("search-monitor")
    x.add_argument("out")
    a = p.parse_args(argv)
    if a.command == "remote-run" and a.format == "mzml" and not a.uuid:
        p.error("--format mzml needs --uuid: a stream that is taken up again keeps the name of its search")
    if a.command == "version":
        print(VERSION)
        return 0
    if a.command == "config":
        print(SearchParams().to_toml(), end="")
        return 0
    spark = session()
    if a.command == "database-build":
        rows = spark.read.text(a.sequences).select(F.col("value").alias("sequence")).where("sequence <> ''").distinct()
        rows = rows.select(sequence_mass(F.col("sequence")).alias("mass"), "sequence", missed_cleavages(F.col("sequence")).cast("short").alias("missed_cleavages"))
        if a.partitions:
            layout.write_laid_out(rows, a.out, a.partitions)
        else:
            tables.write_library(rows, a.out, int(a.bin_dalton * constants.SCALE))
    elif a.command == "search-space-build":
        sp = _params(a.params)
        rows = with_bounds(spark.range(1).select(F.lit(a.mass).cast("long").alias("m")), "m", sp.lower_mass_tolerance_ppm, sp.upper_mass_tolerance_ppm)
        least, most = a.mass - a.mass * sp.lower_mass_tolerance_ppm // 1_000_000, a.mass + a.mass * sp.upper_mass_tolerance_ppm // 1_000_000
        width = C.bin_width(a.mass * 2, sp.lower_mass_tolerance_ppm, sp.upper_mass_tolerance_ppm)
        known = layout.read_layout(spark, a.library)
        library = tables.read_library(spark, a.library, most, least) if known is None else layout.between(tables.read_library(spark, a.library), known.limits, least, most)
        found = C.mass_window_join(rows, library, width, "mass").select("m", F.col("sequence").alias("peptide"), F.lit(True).alias("is_target"))
        sinks.write_fasta(found, a.out, ["m"], ["peptide"])
    elif a.command == "index-spectrum-file" and a.places:
        mzml.write_places(mzml.spectrum_places(spark, a.mzml, a.without_ms2), a.out)
    elif a.command == "index-spectrum-file":
        mzml.index_json(mzml.spectrum_index(spark, a.mzml, a.without_ms2)).write.mode("overwrite").json(a.out)
    elif a.command == "extract-spectrum":
        if a.index:
            found = mzml.extract_places(spark.read.parquet(a.index).where(F.col("spectrum_id") == a.spectrum_id).limit(1))
        else:
            found = mzml.extract_spectrum(spark, a.mzml, a.spectrum_id).limit(1)
        for r in found.collect():
            print(r.mzml, end="")
    elif a.command in ("local-run", "remote-run"):
        sp, most, name = _params(a.params), a.max_dalton * constants.SCALE, a.uuid or str(uuid4())
        library, laid_out = tables.read_library(spark, a.library), layout.read_layout(spark, a.library)
        mods, moving = ptm.UNMODIFIED, ()
        if a.ptms:
            ptms = tables.read_ptms(spark, a.ptms)
            mods, moving = ptm.static_modifications(ptms.where("mod_type <> 'Variable'")), variable.variable_modifications(ptms)
        known = lambda: sinks.read_decoys(spark, a.decoys) if a.decoys and sinks.exists(spark, a.decoys) else None
        step = lambda df: find(df, library, sp, most, mods=mods, cached=known(), variable=moving, params=spark.read.schema(PARAMS).parquet(a.search_params) if a.search_params else None, layout=laid_out)
        if a.command == "remote-run":
            arriving = mzml.watch_spectra(spark, a.spectra, name) if a.format == "mzml" else runner.watch_spectra(spark, a.spectra)
            listener = runner.Progress(lambda row: print(f"batch {row['batch']}: {row['rows']} rows in {row['ms']} ms", flush=True)) if a.follow else None
            if listener:
                spark.streams.addListener(listener)
            runner.run_stream(arriving, step, lambda found, n: store(spark, found, a.out, sp, name, n, a.decoys), a.out + ".checkpoint", once=not a.follow).awaitTermination()
            return 0
        n = store(spark, step(mzml.read_spectra(spark, a.spectra, name)), a.out, sp, name, None, a.decoys)
        print(f"{name}: {n} matches")
    elif a.command == "search-monitor":
        tables.run_listing(spark.read.parquet(a.out)).show(1000, False)
        if sinks.exists(spark, a.out + ".finished"):
            runner.finished_counts(spark, a.out + ".finished").show(1000, False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
