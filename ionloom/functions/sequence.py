"""Column functions over peptide sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ionloom.constants import RESIDUES, WATER, mass_int
from ionloom.operators.ptm import UNMODIFIED, StaticModifications


def missed_cleavages(sequence: Column) -> Column:
    """K or R that is followed by a residue other than P."""
    return F.regexp_count(sequence, F.lit("(?<=[KR])(?!(P|$))"))


def residue_counts(sequence: Column) -> dict[str, Column]:
    return {a: F.length(sequence) - F.length(F.replace(sequence, F.lit(a), F.lit(""))) for a in RESIDUES}


def sequence_mass(sequence: Column, mods: StaticModifications = UNMODIFIED) -> Column:
    """Integer mass of the residues, one water and the static modifications; other letters weigh nothing."""
    masses, ends = mods.masses(), mass_int(WATER) + mods.n_bond + mods.c_bond
    return sum((n.cast("long") * masses[a] for a, n in residue_counts(sequence).items()), F.lit(ends).cast("long"))


def annotated(sequence: Column, mods: StaticModifications) -> Column:
    """The sequence with the integer delta behind each statically modified residue, as in ``C[s57021464]``."""
    for a, delta in mods.residues:
        sequence = F.replace(sequence, F.lit(a), F.lit(f"{a}[s{delta}]"))
    return sequence


def mass_partition(mass: Column, limits: list[int]) -> Column:
    """Number of the first limit that the mass doesn't exceed; the last partition takes the rest."""
    return sum((F.when(mass > x, 1).otherwise(0) for x in limits), F.lit(0)).cast("long")
