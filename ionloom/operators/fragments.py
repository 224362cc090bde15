"""Theoretical b and y ions of peptides."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ionloom.constants import AMMONIA, AMMONIA_LOSS, PROTON, SCALE, WATER, WATER_LOSS, mass_int
from ionloom.operators.ptm import UNMODIFIED, StaticModifications
from ionloom.operators.variable import plain, token_delta, tokens


def residue_rows(peptides: DataFrame, key: str, sequence: str = "sequence", mods: StaticModifications = UNMODIFIED, marked: bool = False) -> DataFrame:
    """One row a residue: key, place (from 1), integer mass, and the masses of all residues up to it and of the whole.

    With ``marked`` the sequences are forms whose marks add to their residue; a bond's mark adds to the residue at that end.
    """
    masses = F.create_map(*(x for a, m in mods.masses().items() for x in (F.lit(a), F.lit(m).cast("long"))))
    rows = peptides.select(key, F.posexplode(tokens(F.col(sequence)) if marked else F.split(sequence, "")).alias("i", "residue")).where("residue <> ''")
    extra = token_delta(F.col("residue")) if marked else F.lit(0).cast("long")
    letter = plain(F.col("residue")) if marked else F.col("residue")
    rows = rows.select(key, (F.col("i") + 1).alias("place"), (F.coalesce(masses[letter], F.lit(0).cast("long")) + extra).alias("m"))
    w = Window.partitionBy(key).orderBy("place")
    return rows.withColumns({"prefix": F.sum("m").over(w.rowsBetween(Window.unboundedPreceding, 0)), "whole": F.sum("m").over(Window.partitionBy(key)), "n": F.count(F.lit(1)).over(Window.partitionBy(key))})


def ions(peptides: DataFrame, key: str, kinds: tuple[str, ...] = ("B", "Y"), max_charge: int = 1, sequence: str = "sequence", mods: StaticModifications = UNMODIFIED, marked: bool = False) -> DataFrame:
    """key, kind, number, charge and m/z of all ions; a b ion is a proper prefix, a y ion a proper suffix with one water; each has its bond's delta."""
    rows = residue_rows(peptides, key, sequence, mods, marked).where("place < n")
    both = {"B": (F.col("place"), F.col("prefix") + mods.n_bond), "Y": (F.col("n") - F.col("place"), F.col("whole") - F.col("prefix") + mass_int(WATER) + mods.c_bond)}
    each = F.array(*(F.struct(F.lit(k).alias("kind"), both[k][0].cast("long").alias("number"), both[k][1].alias("mass")) for k in kinds))
    rows = rows.select(key, F.explode(each).alias("x")).select(key, "x.*")
    rows = rows.withColumn("charge", F.explode(F.sequence(F.lit(1), F.lit(max_charge))))
    return rows.select(key, "kind", "number", "charge", ((F.col("mass") / SCALE + F.col("charge") * PROTON) / F.col("charge")).alias("mz"))


#: Neutral losses: name, integer mass, and the residues of which a fragment must have one.
LOSSES = (("H2O", mass_int(WATER), WATER_LOSS), ("NH3", mass_int(AMMONIA), AMMONIA_LOSS))


def loss_ions(peptides: DataFrame, key: str, kinds: tuple[str, ...] = ("B", "Y"), max_charge: int = 1, sequence: str = "sequence", mods: StaticModifications = UNMODIFIED, marked: bool = False) -> DataFrame:
    """The ions of ``ions`` less water or ammonia, as kinds like ``B-H2O``, where the fragment has a residue that loses it."""
    letters = peptides.select(key, (plain(F.col(sequence)) if marked else F.col(sequence)).alias("letters"))
    rows = ions(peptides, key, kinds, max_charge, sequence, mods, marked).join(letters, key)
    part = F.when(F.col("kind") == "B", F.left("letters", F.col("number").cast("int"))).otherwise(F.right("letters", F.col("number").cast("int")))
    each = F.array(*(F.when(part.rlike(f"[{residues}]"), F.struct(F.concat("kind", F.lit(f"-{name}")).alias("kind"), (F.col("mz") - F.lit(mass / SCALE) / F.col("charge")).alias("mz"))) for name, mass, residues in LOSSES))
    rows = rows.withColumn("x", F.explode(F.array_compact(each)))
    return rows.select(key, "x.kind", "number", "charge", "x.mz")
