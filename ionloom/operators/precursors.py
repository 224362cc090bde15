"""Spectra to precursors: level filter, charge expansion, neutral and integer masses, tolerance bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ionloom.constants import PROTON, SCALE


def ms2_spectra(spectra: DataFrame) -> DataFrame:
    """Level-2 spectra; a missing level drops the spectrum."""
    return spectra.where(F.col("ms_level") == 2)


def charges(charge_state: Column, possible: Column, max_charge: int | Column) -> Column:
    """Given charges (all stated ones, then all possible ones, no deduplication), or 2..max_charge without any."""
    if isinstance(max_charge, Column):
        given = F.concat(F.coalesce(charge_state, F.array().cast("array<smallint>")), F.coalesce(possible, F.array().cast("array<smallint>")))
        default = F.when(max_charge >= 2, F.sequence(F.lit(2), max_charge)).otherwise(F.array().cast("array<int>"))
        return F.when(F.size(given) > 0, given).otherwise(default.cast("array<smallint>"))
    given = F.concat(F.coalesce(charge_state, F.array().cast("array<smallint>")), F.coalesce(possible, F.array().cast("array<smallint>")))
    default = F.sequence(F.lit(2), F.lit(max_charge)) if max_charge >= 2 else F.array()
    return F.when(F.size(given) > 0, given).otherwise(default.cast("array<smallint>"))


def explode_precursors(spectra: DataFrame, max_charge: int | Column = 6) -> DataFrame:
    """One row for each (spectrum, precursor) in order; precursors without charge get the default charges."""
    given = lambda p: F.when(p["charge"].isNotNull(), F.array(p["charge"]))
    one = lambda p: F.transform(charges(given(p), F.lit(None).cast("array<smallint>"), max_charge), lambda z: F.struct(p["mz"].alias("mz"), z.alias("charge")))
    rows = spectra.withColumn("p", F.flatten(F.transform("precursors", one)))
    rows = rows.select(*(c for c in spectra.columns if c != "precursors"), F.posexplode("p").alias("precursor_no", "p"))
    return rows.select("*", F.col("p.mz").alias("precursor_mz"), F.col("p.charge").alias("charge")).drop("p")


def neutral_mass(mz: Column, charge: Column) -> Column:
    return mz * charge - charge * F.lit(PROTON)


def mass_int(mass: Column) -> Column:
    return F.round(mass * SCALE).cast("long")


def ppm_low(mass: Column, ppm: int | Column) -> Column:
    """Lower bound in integer arithmetic, truncating, inclusive."""
    return mass - F.call_function("div", mass * ppm, F.lit(1_000_000))


def ppm_high(mass: Column, ppm: int | Column) -> Column:
    return mass + F.call_function("div", mass * ppm, F.lit(1_000_000))


def with_bounds(precursors: DataFrame, mass: str, lower_ppm: int | Column, upper_ppm: int | Column) -> DataFrame:
    return precursors.withColumns({"lo": ppm_low(F.col(mass), lower_ppm), "hi": ppm_high(F.col(mass), upper_ppm)})
