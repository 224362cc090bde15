"""Cross-correlation of a scan's candidates in one streamed pass: the same scores as ``xcorr``, with one shuffle.

A scan's spectrum row and its candidates are dealt to one task and sorted, the spectrum first.  The spectrum becomes sorted bins with
prefix sums, so the background at any bin is two lookups; candidates follow in batches, so a scan with very many of them is never held.  Ion masses are
prefix sums over a candidate's residues, which need no table of ions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionloom.constants import PROTON, SCALE, WATER, mass_int
from ionloom.operators.fragments import LOSSES
from ionloom.operators.ptm import UNMODIFIED, StaticModifications
from ionloom.operators.variable import TOKEN
from ionloom.params import XcorrParams

_TOKEN, _MARK = re.compile(TOKEN), re.compile(r"\[v(-?[0-9]+)\]")
#: Columns of a candidate, of its spectrum, and of the scores.
CANDIDATE = "peptide string, is_target boolean, library_mass long"
SPECTRUM = "uuid string, ms_run string, spectrum_id string, precursor_no int, precursor_mz double, charge int, precursor_da double, score_threshold double"
SCORES = "xcorr double, ions_total long, ions_matched long"


def residue_masses(form: str, masses: dict[str, int]) -> np.ndarray:
    """Integer masses of a form's residues with their marks; other letters weigh nothing."""
    if "[" not in form:
        return np.array([masses.get(c, 0) for c in form], np.int64)
    out = []
    for token in _TOKEN.findall(form):
        letter = _MARK.sub("", token).replace("-", "")
        out.append(masses.get(letter, 0) + sum(map(int, _MARK.findall(token))))
    return np.array(out, np.int64)


def residue_letters(form: str) -> np.ndarray:
    return np.array(list(form) if "[" not in form else [_MARK.sub("", t).replace("-", "") for t in _TOKEN.findall(form)], str)


class Spectrum:
    """Normalised heights of a spectrum's bins, and the score of any bin."""

    def __init__(self, mz: np.ndarray, intensity: np.ndarray, p: XcorrParams):
        self.p = p
        kept = intensity >= p.minimum_intensity
        bins = np.floor(mz[kept] / p.bin_size + 1 - p.bin_offset).astype(np.int64)
        self.bins, at = np.unique(bins, return_inverse=True)
        height = np.zeros(len(self.bins))
        np.maximum.at(height, at, np.sqrt(intensity[kept]))
        if len(height):
            _, part = np.unique(np.floor(self.bins * p.windows / (self.bins[-1] + 1)), return_inverse=True)
            top = np.zeros(part.max() + 1)
            np.maximum.at(top, part, height)
            height = np.divide(height * 50, top[part], out=np.zeros_like(height), where=top[part] > 0)
        self.height, self.sums = height, np.concatenate([[0.0], np.cumsum(height)])

    def heights(self, bins: np.ndarray) -> np.ndarray:
        if not len(self.bins):
            return np.zeros(len(bins))
        at = np.minimum(np.searchsorted(self.bins, bins), len(self.bins) - 1)
        return np.where(self.bins[at] == bins, self.height[at], 0.0)

    def _fast(self, bins: np.ndarray) -> np.ndarray:
        y, n = self.heights(bins), self.p.background
        near = self.sums[np.searchsorted(self.bins, bins + n, "right")] - self.sums[np.searchsorted(self.bins, bins - n)]
        return y - (near - y) / (2 * n)

    def scores(self, bins: np.ndarray) -> np.ndarray:
        fast = self._fast(bins)
        return fast + 0.5 * (self._fast(bins - 1) + self._fast(bins + 1)) if self.p.use_flanking_peaks else fast


def _batch(spectrum: Spectrum, charge: int, forms: list[str], ions) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """xcorr, number of ions and of matched ions of each form."""
    p = spectrum.p
    masses = [ions(f) for f in forms]
    n = np.array([len(m) for m in masses])
    z = np.arange(1, max(1, min((charge or 0) - 1, p.max_fragment_charge)) + 1)[:, None]
    flat = np.concatenate(masses)
    bins = np.floor(((flat / SCALE + z * PROTON) / z) / p.bin_size + 1 - p.bin_offset).astype(np.int64)
    shape = bins.shape
    score = spectrum.scores(bins.ravel()).reshape(shape).sum(0)
    hit = np.concatenate([[0], np.cumsum((spectrum.heights(bins.ravel()) > 0).reshape(shape).sum(0))])
    ends = np.concatenate([[0], np.cumsum(n)])
    # each form's own slice is summed: differences of running sums would carry rounding from form to form
    xcorr = np.array([score[a:b].sum() for a, b in zip(ends[:-1], ends[1:], strict=True)])
    return xcorr * 0.005, n * shape[0], hit[ends[1:]] - hit[ends[:-1]]


def scored(rows: DataFrame, candidates: DataFrame, p: XcorrParams, mods: StaticModifications = UNMODIFIED) -> DataFrame:
    """xcorr, ions_total and ions_matched of each candidate (scan, peptide, is_target, library_mass) with its spectrum's columns.

    ``rows`` has one row a scan with mz, intensity and charge.  Candidates without ions or without a spectrum are left out; peaks that are null count
    nothing.
    """
    parts = mods.masses()
    n_bond, c_bond, kinds = mods.n_bond, mods.c_bond, p.ions
    names = [x.split()[0] for x in (CANDIDATE + ", " + SPECTRUM).split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(1 << 14)
        def ions(form: str) -> np.ndarray:
            m = residue_masses(form, parts)
            prefix = np.cumsum(m)
            each = {"B": prefix[:-1] + n_bond, "Y": prefix[-1:] - prefix[:-1] + mass_int(WATER) + c_bond}
            if len(m) < 2:
                return np.zeros(0, np.int64)
            out = [each[k] for k in kinds]
            for _, mass, residues in LOSSES if p.use_neutral_loss_ions else ():
                n = np.cumsum(np.isin(residue_letters(form), list(residues)))
                has = {"B": n[:-1] > 0, "Y": n[-1] > n[:-1]}
                out += [each[k][has[k]] - mass for k in kinds]
            return np.concatenate(out)

        numbers = lambda values, i: np.array([np.nan if x is None else x for x in values[i].as_py() or []], float)
        scan, spectrum, meta = None, None, None
        for batch in batches:
            scans, kind = batch.column("scan").to_pylist(), batch.column("kind").to_pylist()
            forms = batch.column("peptide").to_pylist()
            at = 0
            while at < len(scans):
                if kind[at] == 0:
                    mz, intensity = numbers(batch.column("mz"), at), numbers(batch.column("intensity"), at)
                    n = min(len(mz), len(intensity))
                    good = ~(np.isnan(mz[:n]) | np.isnan(intensity[:n]))
                    scan, spectrum = scans[at], Spectrum(mz[:n][good], intensity[:n][good], p)
                    meta = {c: batch.column(c)[at] for c in names[3:]}
                    at += 1
                    continue
                end = at
                while end < len(scans) and kind[end] and scans[end] == scans[at]:
                    end += 1
                if scans[at] == scan:
                    x, total, matched = _batch(spectrum, meta["charge"].as_py(), forms[at:end], ions)
                    some = pa.array(total > 0)
                    own = [batch.column(c).slice(at, end - at) for c in names[:3]]
                    shared = [pa.repeat(meta[c], end - at) for c in names[3:]]
                    out = pa.RecordBatch.from_arrays([*own, *shared, pa.array(x), pa.array(total.astype(np.int64)), pa.array(matched.astype(np.int64))], [*names, "xcorr", "ions_total", "ions_matched"])
                    yield out.filter(some)
                at = end

    rows = rows if "score_threshold" in rows.columns else rows.withColumn("score_threshold", F.lit(None).cast("double"))
    null = lambda kind: F.lit(None).cast(kind)
    typed = [tuple(x.split()) for x in SPECTRUM.split(", ")]
    peaks = [("mz", "array<double>"), ("intensity", "array<double>")]
    spectra = rows.select("scan", F.lit(0).alias("kind"), null("string").alias("peptide"), null("boolean").alias("is_target"), null("long").alias("library_mass"), *(F.col(c).cast(k).alias(c) for c, k in typed + peaks))
    listed = candidates.select("scan", F.lit(1).alias("kind"), "peptide", "is_target", F.col("library_mass").cast("long"), *(null(k).alias(c) for c, k in typed + peaks))
    dealt = spectra.unionAll(listed).repartition("scan").sortWithinPartitions("scan", "kind", "peptide")
    return dealt.mapInArrow(run, ", ".join((CANDIDATE, SPECTRUM, SCORES)))
