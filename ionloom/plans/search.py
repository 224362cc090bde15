"""The search: spectra, precursors, candidates, scores, features, outlier probabilities.

Spectra and candidates are written once to the shared folder, so files are parsed once however many results are taken from a run.  Candidates come
from mass windows, with variable modifications from windows moved by each combination; scores are one streamed pass over each scan's candidates.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ionloom.functions.sequence import annotated, missed_cleavages, sequence_mass
from ionloom.operators import candidates as C
from ionloom.operators import decoys as D
from ionloom.operators import features, loop, precursors, scan_scores
from ionloom.operators import membership as M
from ionloom.operators import variable as V
from ionloom.operators.ptm import UNMODIFIED, StaticModifications
from ionloom.params import SearchParams
from ionloom.session import discard, written
from ionloom.sources.layout import Layout, touched
from ionloom.sources.tables import within

SCAN = ["uuid", "ms_run", "spectrum_id", "precursor_no"]
#: Rounds of new decoys for scans that are still short, each with seeds of its own.
DECOY_ROUNDS = 4
UNIT = ["scan", "units"]
#: New decoys that one task is asked for.
DECOYS_A_TASK = 50_000


#: What a search may set for itself, in a table with one row a search and version; nulls leave the run's value.
BY_SEARCH = {"max_charge": "int", "lower_mass_tolerance_ppm": "int", "upper_mass_tolerance_ppm": "int", "max_variable_modifications": "int", "decoys_per_peptide": "int", "score_threshold": "double"}
PARAMS = "uuid string, version long, " + ", ".join(f"{k} {v}" for k, v in BY_SEARCH.items())


def latest_params(params: DataFrame) -> DataFrame:
    """uuid and the values of each search's latest version."""
    last = params.groupBy("uuid").agg(F.max_by(F.struct(*BY_SEARCH), "version").alias("p"))
    return last.select("uuid", *(F.col(f"p.{c}").cast(kind).alias(c) for c, kind in BY_SEARCH.items()))


def with_params(spectra: DataFrame, p: SearchParams, params: DataFrame | None = None) -> DataFrame:
    """Spectra with the parameters of their search as columns: those of ``params`` (see ``PARAMS``) by uuid, else those of ``p``."""
    own = {c: F.lit(getattr(p, c)).cast(kind) for c, kind in BY_SEARCH.items()}
    if params is None:
        return spectra.withColumns(own)
    known = latest_params(params)
    joined = spectra.join(known.select("uuid", *(F.col(c).alias(f"of_{c}") for c in BY_SEARCH)), "uuid", "left")
    return joined.withColumns({c: F.coalesce(f"of_{c}", own[c]) for c in BY_SEARCH}).drop(*(f"of_{c}" for c in BY_SEARCH))


def precursor_rows(spectra: DataFrame, p: SearchParams) -> DataFrame:
    """Precursors with integer mass, bounds and one scan key; spectra may carry their search's parameters (``with_params``)."""
    spectra = spectra if "lower_mass_tolerance_ppm" in spectra.columns else with_params(spectra, p)
    rows = precursors.explode_precursors(precursors.ms2_spectra(spectra), F.col("max_charge"))
    rows = rows.withColumn("precursor_da", precursors.neutral_mass(F.col("precursor_mz"), F.col("charge"))).where("precursor_da > 0")
    rows = rows.withColumn("mass_int", precursors.mass_int(F.col("precursor_da"))).withColumn("scan", F.to_json(F.struct(*SCAN, "precursor_mz", "charge")))
    return precursors.with_bounds(rows, "mass_int", F.col("lower_mass_tolerance_ppm"), F.col("upper_mass_tolerance_ppm"))


def spectrum_errors(spectra: DataFrame) -> DataFrame:
    """uuid, ms_run, spectrum_id, precursor and error of what the search can't use; one row each, as ``append_errors`` takes them."""
    ms2 = precursors.ms2_spectra(spectra).select("uuid", "ms_run", "spectrum_id", "mz", "intensity", "precursors")
    none = F.lit(None).cast("struct<mz:double,charge:smallint>")
    said = F.when(F.coalesce(F.size("mz"), F.lit(0)) <= 0, "no peaks").when(~F.coalesce(F.size("mz") == F.size("intensity"), F.lit(False)), "arrays differ in length").when(F.coalesce(F.size("precursors"), F.lit(0)) <= 0, "no precursor")
    whole = ms2.select("uuid", "ms_run", "spectrum_id", none.alias("precursor"), said.alias("error")).where("error is not null")
    each = ms2.select("uuid", "ms_run", "spectrum_id", F.explode("precursors").alias("p"))
    each = each.select("uuid", "ms_run", "spectrum_id", F.col("p").cast("struct<mz:double,charge:smallint>").alias("precursor"))
    bad = F.when(F.col("precursor.mz").isNull() | F.isnan("precursor.mz"), "precursor without m/z").when(F.col("precursor.mz") <= 0, "precursor m/z is not positive")
    return whole.unionAll(each.withColumn("error", bad).where("error is not null"))


@dataclass(frozen=True)
class SearchSpace:
    """Candidates of all scans, the decoys among them that are new, and what scans lack after all rounds (scan, units, missing)."""

    candidates: DataFrame
    new_decoys: DataFrame | None = None
    short: DataFrame | None = None
    scratch: tuple[DataFrame, ...] = ()


def _joined(residues: Column) -> Column:
    return F.concat_ws("", F.transform("units", lambda u: F.get(residues, u)))


def _without_library(rows: DataFrame, library: DataFrame, layout: Layout | None) -> DataFrame:
    return C.without_targets(rows, library) if layout is None else M.without_known(rows, library, layout.known)


def _new_decoys(short: DataFrame, library: DataFrame, most: int, seed: int, mods: StaticModifications, variable: tuple[V.VariableModification, ...], layout: Layout | None = None, scratch: list[DataFrame] | None = None) -> DataFrame:
    """Generated decoys for (scan, units, delta, mass_int, lo, hi, missing): some more than missing, without targets, with one form each."""
    # where the modifications of a scan's targets need a residue, its decoys have it as well
    at = {c: F.array(*(F.lit(v.residue if v.position == place else "") for v in variable)) for c, place in (("needs", "Anywhere"), ("first", "Terminus_N"), ("last", "Terminus_C"))} if variable else {}
    residues = {c: _joined(a) for c, a in at.items()} or {c: F.lit("") for c in ("needs", "first", "last")}
    asked = F.col("missing") + F.ceil(F.col("missing") / 10) + 5
    wanted = short.select(*UNIT, "delta", F.xxhash64("scan", F.to_json("units"), F.lit(seed)).alias("seed"), "mass_int", "lo", "hi", "missing", asked.alias("asked"), *(e.alias(c) for c, e in residues.items()))
    # few windows may ask for many decoys, so these decide over the tasks
    total = short.agg(F.sum("missing")).first()[0] or 0
    wanted = wanted.repartition(max(short.sparkSession.sparkContext.defaultParallelism, -(-total // DECOYS_A_TASK)), *UNIT)
    D.register(short.sparkSession, mods)
    made = short.sparkSession.sql("SELECT scan, units, delta, missing, nr, sequence FROM {wanted}, LATERAL decoys(seed, mass_int, lo, hi, CAST(asked AS INT), needs, first, last)", wanted=wanted)
    if layout is not None:  # read more than once behind the filter
        made = written(made, "made")
        scratch.append(made)
    made = _without_library(made, library, layout).withColumn("library_mass", sequence_mass(F.col("sequence"), mods) + F.col("delta"))
    return V.one_form(made, "sequence", variable, most, F.xxhash64("scan", "sequence"), mods)


def _first_of_scan(rows: DataFrame, limit: str) -> DataFrame:
    """The first ``limit`` forms of each scan and combination, each form once."""
    rows = rows.dropDuplicates([*UNIT, "form"])
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*UNIT).orderBy("nr", "form"))).where(F.col("place") <= F.col(limit)).select(*UNIT, "sequence", "form", "library_mass", "new")


def search_space(rows: DataFrame, library: DataFrame, p: SearchParams, max_mass: int, seed: int = 0, mods: StaticModifications = UNMODIFIED, cached: DataFrame | None = None, variable: tuple[V.VariableModification, ...] = (), layout: Layout | None = None) -> SearchSpace:
    """scan, peptide, theoretical mass and is_target: forms of library peptides in the window, and decoys that are no targets.

    Masses include the modifications.  Of each scan and combination of variable modifications, decoys are counted by its targets: known ones first
    (``cached``: sequence), then new ones in rounds, until none is short or the rounds are over; what is missing then is told in ``short``.  With the library's ``layout`` only the folders that windows meet are
    read, and its filter keeps decoys that are no targets from the exact lookup.
    """
    if "decoys_per_peptide" not in rows.columns:
        rows = rows.withColumns({c: F.lit(getattr(p, c)) for c in BY_SEARCH if c not in rows.columns})
    # one row: the masses at hand, and the widest of what the searches ask for
    ends = rows.agg(F.min("lo").alias("least"), F.max("hi").alias("most"), F.max("lower_mass_tolerance_ppm").alias("lower"), F.max("upper_mass_tolerance_ppm").alias("upper"), F.max("max_variable_modifications").alias("sites"), F.max("decoys_per_peptide").alias("decoys")).first()
    width = C.bin_width(max_mass, ends.lower or 0, ends.upper or 0)
    most = (ends.sites or 0) if variable else 0
    windows = V.shifted_windows(rows.select("scan", "mass_int", "lo", "hi", "max_variable_modifications", "decoys_per_peptide"), variable, most)
    windows = windows.where(F.size("units") <= F.greatest("max_variable_modifications", F.lit(0)))
    if mods == UNMODIFIED and layout is not None:  # moved windows name masses without modifications, so they prune as well
        library_rows = touched(library, windows, layout.limits)
    elif mods == UNMODIFIED and not variable:
        library_rows = within(library, ends.least or 0, ends.most or 0)
    else:  # the library's masses are those without modifications
        library_rows = library
    mass = F.col("mass") if mods == UNMODIFIED else sequence_mass(F.col("sequence"), mods)
    peptides = library_rows.select(F.col("sequence").alias("peptide"), mass.alias("library_mass"))
    targets = V.forms(C.mass_window_join(windows, peptides, width), "peptide", variable, most, mods)
    targets = targets.select(*UNIT, F.col("form").alias("peptide"), (F.col("library_mass") + F.col("delta")).alias("library_mass"))
    targets = written(targets, "targets")
    if not ends.decoys:
        return SearchSpace(targets.drop("units").withColumn("is_target", F.lit(True)), scratch=(targets,))
    counts = targets.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("targets"))
    needed = windows.join(counts, UNIT).withColumn("needed", F.col("targets") * F.col("decoys_per_peptide")).drop("targets", "decoys_per_peptide", "max_variable_modifications")
    needed = written(needed.where("needed > 0"), "needed")
    none = needed.select(*UNIT, F.lit("").alias("sequence"), F.lit("").alias("form"), F.lit(0).cast("long").alias("library_mass"), F.lit(False).alias("new")).limit(0)
    parts = [none]
    if cached is not None:
        pool = _without_library(cached.select("sequence"), library, layout).distinct().select("sequence", sequence_mass(F.col("sequence"), mods).alias("pool_mass"))
        known = C.mass_window_join(needed, pool, width, "pool_mass").withColumn("library_mass", F.col("pool_mass") + F.col("delta"))
        known = V.one_form(known, "sequence", variable, most, F.xxhash64("scan", "sequence"), mods)
        parts.append(written(_first_of_scan(known.withColumns({"nr": F.lit(0), "new": F.lit(False)}), "needed"), "decoys"))
    scratch = [targets, needed]
    for n in range(DECOY_ROUNDS + 1):
        have = reduce(DataFrame.unionAll, parts)
        short = needed.join(have.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("have")), UNIT, "left")
        short = short.withColumn("missing", F.col("needed") - F.coalesce("have", F.lit(0))).where("missing > 0").select(*UNIT, "delta", "mass_int", "lo", "hi", "missing")
        short = written(short, "short")
        scratch.append(short)
        if n == DECOY_ROUNDS or short.isEmpty():
            break
        made = _new_decoys(short, library, most, seed + n * 1_000_003, mods, variable, layout, scratch).join(have.select(*UNIT, "form"), [*UNIT, "form"], "left_anti")
        parts.append(written(_first_of_scan(made.withColumn("new", F.lit(True)), "missing"), "decoys"))
    have = reduce(DataFrame.unionAll, parts)
    all_rows = C.union_candidates(targets.drop("units"), have.select("scan", F.col("form").alias("peptide"), "library_mass"))
    new = have.where("new").select("sequence").distinct()
    new = new.select(sequence_mass(F.col("sequence"), mods).alias("mass"), "sequence", missed_cleavages(F.col("sequence")).cast("short").alias("missed_cleavages"))
    return SearchSpace(all_rows, new, short, (*scratch, *parts[1:]))


def candidate_rows(rows: DataFrame, library: DataFrame, p: SearchParams, max_mass: int, seed: int = 0, mods: StaticModifications = UNMODIFIED, cached: DataFrame | None = None, variable: tuple[V.VariableModification, ...] = ()) -> DataFrame:
    """The candidates of ``search_space``."""
    return search_space(rows, library, p, max_mass, seed, mods, cached, variable).candidates


def match_rows(rows: DataFrame, candidates: DataFrame, p: SearchParams, mods: StaticModifications = UNMODIFIED) -> DataFrame:
    """One row for each scan and candidate with xcorr, ion counts and features."""
    limit = F.coalesce("score_threshold", F.lit(float("-inf"))) if "score_threshold" in rows.columns else F.lit(p.score_threshold)
    spectra = rows.select("scan", *SCAN, "precursor_mz", "charge", "precursor_da", limit.alias("score_threshold"), "mz", "intensity")
    out = scan_scores.scored(spectra, candidates, p.xcorr, mods).where("xcorr >= score_threshold")
    out = out.select(*SCAN, F.col("spectrum_id").alias("scan_id"), "peptide", "is_target", F.col("charge").cast("short").alias("charge"), "precursor_mz", "precursor_da", F.col("precursor_da").alias("experimental_mass"), "xcorr", "ions_total", "ions_matched", (F.col("library_mass") / 1_000_000).alias("theoretical_mass"), F.lit(None).cast("double").alias("second_theoretical_mass"))
    return features.with_features(out)


@dataclass(frozen=True)
class Found:
    """What a search has: precursors, its search space, matches, errors, and seconds of the steps."""

    spectra: DataFrame
    rows: DataFrame
    space: SearchSpace
    matches: DataFrame
    errors: DataFrame
    seconds: dict[str, float]

    def discard(self) -> None:
        """Deletes the scratch tables; nothing of the search can be read afterwards."""
        discard(self.spectra, *self.space.scratch)


def find(spectra: DataFrame, library: DataFrame, p: SearchParams, max_mass: int, seed: int = 0, mods: StaticModifications = UNMODIFIED, cached: DataFrame | None = None, variable: tuple[V.VariableModification, ...] = (), params: DataFrame | None = None, layout: Layout | None = None) -> Found:
    """A whole search over ``spectra``, which are read once; ``max_mass`` bounds the integer masses of precursors.

    ``params`` (see ``PARAMS``) gives searches values of their own, so spectra of unlike searches go through one batch.
    """
    began = time.monotonic()
    stored = written(with_params(spectra, p, params) if params is not None else spectra, "spectra")
    rows = precursor_rows(stored, p)
    read = time.monotonic()
    space = search_space(rows, library, p, max_mass, seed, mods, cached, variable, layout)
    seconds = {"spectra": read - began, "search_space_generation": time.monotonic() - read}
    began = time.monotonic()
    scored = written(match_rows(rows, space.candidates, p, mods), "matches")
    seconds["identification"] = time.monotonic() - began
    began = time.monotonic()
    matches = loop.with_loop(scored, SCAN, ["xcorr", "ions_matched_ratio", "mass_error"], ["peptide"])
    discard(scored)
    seconds["scoring"] = time.monotonic() - began
    errors = spectrum_errors(stored)
    if space.short is not None:
        scans = rows.select("scan", "uuid", "ms_run", "spectrum_id", F.struct(F.col("precursor_mz").alias("mz"), F.col("charge").cast("short").alias("charge")).alias("precursor"))
        lacking = space.short.groupBy("scan").agg(F.sum("missing").alias("missing")).join(scans, "scan")
        errors = errors.unionAll(lacking.select("uuid", "ms_run", "spectrum_id", F.col("precursor").cast("struct<mz:double,charge:smallint>").alias("precursor"), F.concat(F.col("missing").cast("string"), F.lit(" decoys missing")).alias("error")))
    return Found(stored, rows, space, matches.withColumn("peptide", annotated(F.col("peptide"), mods)), errors, seconds)


def search(spectra: DataFrame, library: DataFrame, p: SearchParams, max_mass: int, seed: int = 0, mods: StaticModifications = UNMODIFIED, cached: DataFrame | None = None, variable: tuple[V.VariableModification, ...] = ()) -> DataFrame:
    """Scored matches of all spectra; peptides carry the marks of their modifications."""
    return find(spectra, library, p, max_mass, seed, mods, cached, variable).matches
