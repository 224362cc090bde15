"""Residue alphabets with post-translational modifications, and tables over residues."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ionloom.constants import RESIDUES, mass_int

PTM_SCHEMA = "amino_acid string, mass_delta double, mod_type string, position string"


@dataclass(frozen=True)
class StaticModifications:
    """Integer mass deltas that every peptide carries: of residues anywhere, and of the two terminal bonds."""

    residues: tuple[tuple[str, int], ...] = ()
    n_bond: int = 0
    c_bond: int = 0

    def delta(self, residue: str) -> int:
        return dict(self.residues).get(residue, 0)

    def masses(self) -> dict[str, int]:
        """Integer masses of all residues with their deltas."""
        return {a: mass_int(m) + self.delta(a) for a, m in RESIDUES.items()}


UNMODIFIED = StaticModifications()


def static_modifications(ptms: DataFrame) -> StaticModifications:
    """Static modifications from a table with one row a residue and position; of several deltas of a bond the first counts.

    Variable modifications (``variable_modifications`` takes them) and static ones of a residue at a terminus are refused.
    """
    rows = ptms.collect()
    if odd := [r for r in rows if r.mod_type != "Static" or r.position not in ("Anywhere", "Bond_N", "Bond_C")]:
        raise ValueError(f"only static modifications anywhere or of a bond are searched: {odd[0]}")
    bond = lambda at: next((mass_int(r.mass_delta) for r in rows if r.position == at), 0)
    return StaticModifications(tuple(sorted((r.amino_acid, mass_int(r.mass_delta)) for r in rows if r.position == "Anywhere")), bond("Bond_N"), bond("Bond_C"))


def residue_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a, mass_int(m)) for a, m in RESIDUES.items()], "residue string, mass long")


def static_residues(ptms: DataFrame) -> DataFrame:
    return ptms.where("mod_type = 'Static'").select(F.col("amino_acid").alias("residue")).distinct()


def alphabet(residues: DataFrame, ptms: DataFrame) -> DataFrame:
    """Residues without a static modification, and the statically modified ones that may stand anywhere."""
    plain = residues.join(static_residues(ptms), "residue", "left_anti").withColumn("delta", F.lit(0).cast("long"))
    moved = ptms.where("mod_type = 'Static' and position = 'Anywhere'").select(F.col("amino_acid").alias("residue"), F.round(F.col("mass_delta") * 1_000_000).cast("long").alias("delta"))
    return plain.unionByName(residues.join(moved, "residue")).select("residue", "mass", "delta", (F.col("mass") + F.col("delta")).alias("total"))


def bond_delta(ptms: DataFrame, position: str) -> Column:
    """First static modification of a terminal bond in table order, 0 without any."""
    return F.coalesce(F.first(F.when((F.col("mod_type") == "Static") & (F.col("position") == position), F.col("mass_delta")), ignorenulls=True), F.lit(0.0))


def cleavage_parts(parts: DataFrame) -> DataFrame:
    """Parts that may stand at the cleavage terminus."""
    return parts.where(F.col("residue").isin("K", "R"))


def distance_matrix(parts: DataFrame) -> DataFrame:
    """Mass differences of all residue pairs; the table holds one row a residue, so the pairs are few."""
    rows = parts.agg(F.collect_list(F.struct("residue", "total")).alias("x"))
    rows = rows.select(F.explode("x").alias("a"), "x").select("a", F.explode("x").alias("b"))
    return rows.select(F.col("a.residue").alias("from_residue"), F.col("b.residue").alias("to_residue"), (F.col("b.total") - F.col("a.total")).alias("distance"))


def nearest_residue(needs: DataFrame, parts: DataFrame, need: str = "need") -> DataFrame:
    """For each row the residue whose mass is nearest to ``need``; ties go to the first letter.  The residues are a literal array."""
    listed = F.array(*(F.struct(F.lit(r.total).cast("long").alias("m"), F.lit(r.residue).alias("r")) for r in parts.select("residue", "total").orderBy("residue").collect()))
    best = F.array_min(F.transform(listed, lambda x: F.struct(F.abs(x["m"] - F.col(need)).alias("d"), x["r"].alias("r"))))
    return needs.withColumn("best", best).select(*needs.columns, F.col("best.r").alias("residue"), F.col("best.d").alias("distance"))
