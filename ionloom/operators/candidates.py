"""Candidate lists: mass-window range join, decoy unions, top-up, limits and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ionloom.session import dealt

#: Rows of one task of a top-up, which are sorted in memory.
ROWS_A_TASK = 500_000


def bin_width(max_mass: int, lower_ppm: int, upper_ppm: int) -> int:
    """A width no window up to ``max_mass`` exceeds, so that a window touches two bins at most."""
    return max(1, max_mass * (lower_ppm + upper_ppm) // 1_000_000 + 2)


def mass_window_join(precursors: DataFrame, library: DataFrame, width: int, mass: str = "library_mass") -> DataFrame:
    """Every library row with ``lo`` <= mass <= ``hi`` for every precursor row, as an equi-join on mass bins.

    A library row lies in one bin, so no pair comes twice.  Rows with null bounds or lo > hi match nothing.  A crowded bin is
    split by adaptive execution, as both sides are plain shuffles.
    """
    bins = F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))
    left = precursors.where("lo <= hi").withColumn("mass_bin", F.explode(bins))
    right = library.withColumn("mass_bin", F.floor(F.col(mass) / width))
    return left.join(right, "mass_bin").where((F.col(mass) >= F.col("lo")) & (F.col(mass) <= F.col("hi"))).drop("mass_bin")


def with_ends(precursors: DataFrame, library: DataFrame, width: int, mass: str = "library_mass") -> DataFrame:
    """Precursors with ``least`` and ``most``, the lowest and highest library mass in their window; those of empty windows go.

    Windows of equal ends hold the same library rows, so that a step over candidates is done once for each pair of ends (``spaces``), not once a
    scan.  Only distinct windows and distinct masses meet here.
    """
    windows = precursors.where("lo <= hi").select("lo", "hi").distinct()
    met = mass_window_join(windows, library.select(mass).distinct(), width, mass)
    return precursors.join(met.groupBy("lo", "hi").agg(F.min(mass).alias("least"), F.max(mass).alias("most")), ["lo", "hi"])


def spaces(ends: DataFrame, library: DataFrame, width: int, mass: str = "library_mass") -> DataFrame:
    """The library rows of each pair of ``least`` and ``most``, which are those of all its windows."""
    pairs = ends.select("least", "most").distinct().withColumns({"lo": F.col("least"), "hi": F.col("most")})
    return mass_window_join(pairs, library, width, mass).drop("lo", "hi")


def first_of_windows(precursors: DataFrame, library: DataFrame, width: int, keys: list[str], order: list[str], limit: int, mass: str = "library_mass") -> DataFrame:
    """At most ``limit`` library rows of each scan by mass, then ``order``.

    Of one mass only the first ``limit`` rows can be among them, so the others go before windows are looked up; equal windows are looked up once.
    """
    first = limited(library.where(F.col(mass).isNotNull()), [mass], order, limit)
    windows = precursors.where("lo <= hi").select("lo", "hi").distinct()
    found = limited(mass_window_join(windows, first, width, mass), ["lo", "hi"], [mass, *order], limit)
    return limited(precursors.join(found, ["lo", "hi"]), keys, [mass, *order], limit)


def known_targets(decoys: DataFrame, targets: DataFrame, key: str = "sequence") -> DataFrame:
    return decoys.join(targets.select(key), key, "left_semi")


def without_targets(decoys: DataFrame, targets: DataFrame, key: str = "sequence") -> DataFrame:
    """Decoys that are no known target; repeated decoys stay."""
    return decoys.join(targets.select(key), key, "left_anti")


def union_candidates(targets: DataFrame, decoys: DataFrame) -> DataFrame:
    """Targets and decoys with their mark, nothing deduplicated."""
    return targets.withColumn("is_target", F.lit(True)).unionByName(decoys.withColumn("is_target", F.lit(False)))


def needed_decoys(candidates: DataFrame, keys: list[str], per_peptide: int) -> DataFrame:
    """Targets and decoys of each scan, and the decoys that are to be there."""
    counts = candidates.groupBy(*keys).agg(F.count_if("is_target").alias("targets"), F.count_if(~F.col("is_target")).alias("decoys"))
    return counts.withColumn("needed", F.col("targets") * per_peptide)


def top_up(cached: DataFrame, generated: DataFrame, needed: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Cached decoys first, then generated ones, up to ``needed`` of each scan; the number of tasks grows with the decoys, not a task's sorts."""
    rows = dealt(cached.withColumn("rank", F.lit(0)).unionByName(generated.withColumn("rank", F.lit(1))), ROWS_A_TASK, *keys)
    w = Window.partitionBy(*keys).orderBy("rank", *order)
    rows = rows.join(needed.where("needed > 0").select(*keys, "needed"), keys).withColumn("nr", F.row_number().over(w))
    return rows.where("nr <= needed").drop("nr", "needed")


def limited(candidates: DataFrame, keys: list[str], order: list[str], limit: int) -> DataFrame:
    """At most ``limit`` candidates of each scan, in order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return candidates.withColumn("nr", F.row_number().over(w)).where(F.col("nr") <= limit).drop("nr")


def size_metric(candidates: DataFrame, keys: list[str], peptide: str = "peptide") -> DataFrame:
    """Bytes (four a byte of peptide) and number of candidates of each scan."""
    return candidates.groupBy(*keys).agg((F.sum(F.octet_length(peptide)) * 4).cast("long").alias("size"), F.count(F.lit(1)).alias("len"))
